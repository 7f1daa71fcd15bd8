from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests.conftest import ROOT, sf_dir
from tests.oracle_check import compare

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "substring_dedup", "decontamination", "bpe",
    ]


def test_sql_agrees(spark):
    report = compare(spark, sf_dir("0.001"), ["op1_substring", "op6_embeddings", "op11_conversations", "op13_manifest"])
    assert all(v["columns_match"] and v["values_match"] for v in report.values()), report


def test_entry_without_the_optional_parts():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('clickscope.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert names and not any(n.startswith('op') for n in names) and 'pipeline' not in names\n"
        "assert set(e.oracle_sql()) == set(names)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": ROOT})
