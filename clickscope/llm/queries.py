"""The registered queries of this subpackage, and their DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickscope.llm import (
    bpe,
    conversations,
    decontaminate,
    embeddings,
    language,
    licences,
    manifest,
    records,
    sharding,
    simhash,
    substring,
    toxicity,
    urls,
)
from clickscope.llm.common import read_table

#: Vocabulary file of the token queries, by its name in the tokenizers folder.
VOCABULARY = "word_bpe_49k.json"
END_ID = 1


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed_words(read_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return records.id_checksums(records.encode_to_records(docs, vocabulary_path(), END_ID))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(language.learnable(docs)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(read_table(spark, sf_dir, "conversations"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, sf_dir, "pages"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_manifest(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring": op1_substring,
        "op2_sharding": op2_sharding,
        "op3_bpe": op3_bpe,
        "op4_records": op4_records,
        "op5_licences": op5_licences,
        "op6_embeddings": op6_embeddings,
        "op7_simhash": op7_simhash,
        "op8_language": op8_language,
        "op9_toxicity": op9_toxicity,
        "op10_decontaminate": op10_decontaminate,
        "op11_conversations": op11_conversations,
        "op12_urls": op12_urls,
        "op13_manifest": op13_manifest,
    }


OP1_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
places AS (
    SELECT r, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word,
           len(words) AS n_words, words
    FROM texts
),
begun AS (
    SELECT r, pos, word,
           CASE WHEN pos + 34 <= n_words THEN md5(array_to_string(words[pos:pos + 34], ' ')) END AS w
    FROM places
),
often AS (SELECT w FROM begun WHERE w IS NOT NULL GROUP BY w HAVING count(*) > 1),
marked AS (
    SELECT r, pos, word,
           max(CASE WHEN w IN (SELECT w FROM often) THEN 1 ELSE 0 END)
               OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM begun
),
kept AS (
    SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept
    FROM marked GROUP BY r
)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (r)
"""


OP6_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
           embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine
    FROM embeddings
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM vectors a JOIN vectors b
      ON a.vec_id <> b.vec_id AND a.fine AND b.fine AND len(a.v) = len(b.v)
     AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reached(a, b) AS (
    SELECT vec_id, vec_id FROM vectors
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
named AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM vectors v JOIN named m USING (vec_id) LEFT JOIN counted c USING (vec_id)
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = f"list_transform(range(0, 8 * strlen({text})), lambda i: (ascii({text}[i // 8 + 1]) >> (i % 8)) & 1)"
    step = "lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), {step}), 4294967295)"


def _op11_sql() -> str:
    """The best repair up to each row and state, as cost, audit and the repaired rows."""

    def then(state: int, cost: str, letters: str, *told: str) -> str:
        v = f"v{state}"
        k = f"printf('%09d', CAST({v}.k[1:9] AS BIGINT) + {cost}) || {v}.k[10:] || '{letters}'"
        return f"CASE WHEN {v} IS NOT NULL THEN struct_pack(k := {k}, t := {v}.t || [{', '.join(told)}]) END"

    user, assistant, kept = "'user:'", "'assistant:'", "w.role || ':' || w.text"
    after = {0: (2, user), 1: (2, user), 2: (3, assistant), 3: (2, user)}
    choices: dict[int, list[str]] = {q: [] for q in range(4)}

    def add(end: int, choice: str, when: str = "TRUE") -> None:
        choices[end].append(f"CASE WHEN {when} THEN {choice} END")

    for q in range(4):
        for inserted in (False, True):
            p, told = (after[q][0], [after[q][1]]) if inserted else (q, [])
            paid, mark = ("2 + ", "I") if inserted else ("", "")
            add(p, then(q, f"{paid}3", f"{mark}D", *told))
            end, role = after[p]
            add(end, then(q, f"{paid}2 + w.cut", f"{mark}R", *told, f"{role} || w.text"), "NOT w.gone")
            for initial, steps in (("s", {0: 1}), ("u", {0: 2, 1: 2, 3: 2}), ("a", {2: 3}), ("", {p: p})):
                if p in steps:
                    add(steps[p], then(q, f"{paid}w.cut", f"{mark}K", *told, kept), f"NOT w.gone AND w.initial = '{initial}'")
    states = ", ".join(f"list_min([{', '.join(choices[q])}]) AS v{q}" for q in range(4))
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    nothing = "CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR[]))"
    return f"""
WITH RECURSIVE spaced AS (
    SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role,
           coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
),
harmed AS (SELECT *, {_crc32("key")} % 20 AS harm FROM spaced),
damaged AS (
    SELECT conv, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
           CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM harmed WHERE harm <> 0
),
numbered AS (
    SELECT *, rtrim(text, {spaces}) AS ended, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM damaged
),
judged AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, nth) AS place,
           CASE WHEN ended = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM numbered
),
w AS (
    SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS cut,
           lag(initial) OVER (PARTITION BY conv ORDER BY place) || initial AS pair
    FROM judged
),
told(conv, place, v0, v1, v2, v3) AS (
    SELECT DISTINCT conv, CAST(0 AS BIGINT), struct_pack(k := '000000000', t := CAST([] AS VARCHAR[])),
           {nothing}, {nothing}, {nothing}
    FROM w
    UNION ALL
    SELECT conv, place, v0, v1, v2, v3 FROM (
        SELECT r.conv, w.place, {states}
        FROM told r JOIN w ON r.conv = w.conv AND w.place = r.place + 1)
),
ended AS (
    SELECT conv, list_min([v0, v3, {then(1, "4", "II", user, assistant)}, {then(2, "2", "I", assistant)}]) AS best
    FROM told JOIN (SELECT conv, max(place) AS place FROM w GROUP BY conv) USING (conv, place)
),
counted AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM w GROUP BY conv
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(CAST(best.k[1:9] AS BIGINT), 0) AS BIGINT) AS cost, coalesce(best.k[10:], '') AS audit,
       sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN ended e ON e.conv = coalesce(CAST(o.conv_id AS VARCHAR), ' ')
LEFT JOIN counted c ON c.conv = coalesce(CAST(o.conv_id AS VARCHAR), ' ')
"""


#: Levels that the manifest's SQL writes out: sources of 3 ** 9 rows, 3 ** 6 sources.
_SOURCE_LEVELS, _ROOT_LEVELS = 9, 6


def _op13_sql() -> str:
    """The tree level by level; each row then climbs with its siblings' digests."""

    def field(name: str, value: str) -> str:
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"

    def leaf(text: str) -> str:
        plain = [field(c, f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join([*plain, field('text', text)])})"

    ctes = [f"""
leaves AS (
    SELECT row_number() OVER () AS r, doc_id, source, {leaf("text")} AS digest,
           CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS other
    FROM documents
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaves
),
a0 AS (SELECT source AS tree, pos, digest FROM placed)"""]

    def grow(name: str, levels: int) -> None:
        for k in range(levels):
            run = "PARTITION BY tree, pos // 3 ORDER BY pos"
            ctes.append(f"""
{name}{k}s AS (
    SELECT tree, pos, digest, count(*) OVER (PARTITION BY tree) AS n,
           coalesce(lag(digest, 2) OVER ({run}), '') || coalesce(lag(digest) OVER ({run}), '') AS l,
           coalesce(lead(digest) OVER ({run}), '') || coalesce(lead(digest, 2) OVER ({run}), '') AS r
    FROM {name}{k}
),
{name}{k + 1} AS (
    SELECT tree, pos // 3 AS pos, CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
    FROM {name}{k}s GROUP BY tree, pos // 3
)""")  # fmt: skip

    def climb(before: str, name: str, levels: int) -> str:
        """Each row's digest and siblings after every level."""
        for k in range(levels):
            ctes.append(f"""
{name}c{k} AS (
    SELECT c.row, c.tree, c.at // 3 AS at, c.proof || s.l || s.r AS proof,
           CASE WHEN s.n = 1 THEN c.digest ELSE sha256(s.l || c.digest || s.r) END AS digest
    FROM {before} c JOIN {name}{k}s s ON s.tree IS NOT DISTINCT FROM c.tree AND s.pos = c.at
)""")
            before = f"{name}c{k}"
        return before

    grow("a", _SOURCE_LEVELS)
    ctes.append(f"""
b0 AS (
    SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, digest, tree AS source
    FROM a{_SOURCE_LEVELS}
)""")
    grow("b", _ROOT_LEVELS)
    ctes.append("""
begun AS (SELECT r AS row, source AS tree, pos AS at, '' AS proof, coalesce(other, digest) AS digest FROM placed)""")
    last = climb("begun", "a", _SOURCE_LEVELS)
    ctes.append(f"""
crossed AS (
    SELECT c.row, b.tree, b.pos AS at, c.proof, c.digest
    FROM {last} c JOIN b0 b ON b.source IS NOT DISTINCT FROM c.tree
)""")
    last = climb("crossed", "b", _ROOT_LEVELS)
    return f"""WITH {",".join(ctes)}
SELECT p.doc_id, p.digest AS leaf, b.digest AS subroot, t.digest AS root, sha256(c.proof) AS proof_sha256,
       c.digest AS folded_root, c.digest = t.digest AS verified,
       p.other IS NOT NULL AND p.other <> p.digest AS tampered
FROM placed p JOIN {last} c ON c.row = p.r JOIN b0 b ON b.source IS NOT DISTINCT FROM p.source
JOIN b{_ROOT_LEVELS} t ON TRUE
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring": OP1_SQL,
        "op6_embeddings": OP6_SQL,
        "op11_conversations": _op11_sql(),
        "op13_manifest": _op13_sql(),
    }
