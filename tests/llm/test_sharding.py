from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from clickscope.llm import sharding as S
from tests.conftest import sf_dir


def test_rebalance_evens_out_and_moves_little():
    r = random.Random(1)
    weight = [int(r.lognormvariate(8, 1.5)) for _ in range(S.VIRTUAL_SLOTS)]
    first = S.first_map()
    edited = S.rebalance(first, weight, S.SHARDS)
    load = Counter()
    for slot, shard in enumerate(edited):
        load[shard] += weight[slot]
    assert max(load.values()) - min(load.values()) <= 0.001 * sum(weight) / S.SHARDS
    moved = sum(a != b for a, b in zip(first, edited))
    assert moved < S.VIRTUAL_SLOTS / 4


def test_rebalance_of_nothing_and_of_one_slot():
    weight = [0] * S.VIRTUAL_SLOTS
    assert S.rebalance(S.first_map(), weight, 8) == S.first_map()
    weight[17] = 1000
    assert len(S.rebalance(S.first_map(), weight, 8)) == S.VIRTUAL_SLOTS


def test_grow_moves_slots_only_into_the_new_shard():
    r = random.Random(2)
    weight = [r.randrange(1, 1000) for _ in range(S.VIRTUAL_SLOTS)]
    edited = S.rebalance(S.first_map(), weight, 8)
    grown = S.grow(edited, weight, 8)
    assert all(a == b or b == 8 for a, b in zip(edited, grown))
    load = Counter()
    for slot, shard in enumerate(grown):
        load[shard] += weight[slot]
    assert max(load.values()) < 1.02 * sum(weight) / 9


def test_stored_versions_stay(spark, tmp_path):
    folder = f"file://{tmp_path}/map"
    S.store_version(spark, folder, 0, [0, 1])
    S.store_version(spark, folder, 1, [1, 1])
    got = {v: [r.shard for r in sorted(S.load_version(spark, folder, v).collect())] for v in (0, 1)}
    assert got == {0: [0, 1], 1: [1, 1]}


def test_positions_and_columns(awkward):
    rows = S.assign_shards(awkward).collect()
    texts = Counter((r.doc_id, r.text) for r in awkward.collect())
    want = Counter()
    for (doc, text), n in texts.items():
        raw = (text or "").encode()
        want[(doc, len(raw) + 1, zlib.crc32(raw))] += n
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def near_equal(rows):
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
        assert 0 <= r.shard < 8
    assert len(load) == 8 and max(load.values()) - min(load.values()) <= 0.02 * max(load.values()), load
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_law_on_a_table(spark):
    near_equal(S.assign_shards(spark.read.parquet(f"{sf_dir('0.1')}/documents.parquet")).collect())


@pytest.mark.parametrize("hot", ["if(id % 3 = 0, 7, id)", "if(id % 3 = 0, null, id)"])
@pytest.mark.parametrize("text", ["concat('text ', id)", "if(id % 3 = 0, 'the same', concat('text ', id))"])
def test_hot_id_and_equal_rows(spark, hot, text):
    docs = spark.range(0, 30_000, 1, 6).selectExpr(f"{hot} as doc_id", f"{text} as text", "'x' as place", "1 as first")
    out = S.assign_shards(docs)
    rows = out.collect()
    assert len(rows) == 30_000
    near_equal(rows)
    assert max(Counter(r.vslot for r in rows).values()) < 30_000 / 50  # what one task may number


def test_empty_table(nothing):
    assert S.assign_shards(nothing).count() == 0
