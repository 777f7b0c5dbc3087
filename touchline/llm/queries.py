"""Named queries of the training-data operators on the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.conversations import damage, repair_report
from touchline.llm.decontaminate import contamination_report
from touchline.llm.exact_dedup import duplicate_groups, normalised
from touchline.llm.hard_negatives import mine_hard_negatives, usable_vectors
from touchline.llm.hmm import score_documents
from touchline.llm.language import bucket, identify, learn_profiles
from touchline.llm.licenses import licenses_sql, scan_licenses
from touchline.llm.line_dedup import SHORTEST, THRESHOLD, line_report
from touchline.llm.minhash import near_duplicates
from touchline.llm.order_minhash import fingerprint_report
from touchline.llm.packing import pack_documents
from touchline.llm.sharding import assign_shards
from touchline.llm.token_files import read_token_files, write_token_files
from touchline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op2_exact_dedup", f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    carry = [F.col("doc_id"), F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256")]
    return duplicate_groups(docs, carry).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_WORDS = r"regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op9_decontaminate", f"""
WITH d AS (SELECT doc_id, {_WORDS.format(t=LOWERED)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(t=LOWERED)} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM grams),
own AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
),
hits AS (SELECT o.doc_id, o.n, o.i, g.item FROM own o JOIN grams g ON o.n = g.n AND o.gram = g.gram),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_packing")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@query("op8_token_files")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path, with_ids=False)


@query("op4_hilbert_shards")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return assign_shards(table(spark, sf, "documents"), ["lang", "source", "text"])


@query("op5_language_id")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = F.coalesce(bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    profiles = learn_profiles(docs.filter(~held_out))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return identify(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")


@query("op7_license_scan", licenses_sql())
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents"))


@query("op6_line_dedup", f"""
WITH l AS (SELECT doc_id, i, s[i] AS line FROM (
  SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)) WHERE s[i] <> ''),
c AS (SELECT line, length(line) AS n, min({{'d': doc_id, 'i': i}}) AS f FROM l GROUP BY line),
p AS (SELECT a.line, b.f AS other FROM c a JOIN c b ON b.n BETWEEN a.n - {THRESHOLD} AND a.n + {THRESHOLD} AND a.line <> b.line
      AND a.n >= {SHORTEST} AND b.n >= {SHORTEST} AND levenshtein(a.line, b.line) <= {THRESHOLD}),
k AS (SELECT line, count(*) AS links, min(other) AS earliest FROM p GROUP BY line),
j AS (SELECT c.f.d AS doc_id, coalesce(links, 0) AS links, earliest IS NULL OR c.f < earliest AS kept FROM c LEFT JOIN k USING (line)),
h AS (SELECT doc_id, sum(links) AS n_links, count(*) FILTER (WHERE kept) AS n_kept FROM j GROUP BY doc_id),
o AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT DISTINCT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
       CAST(coalesce(n, 0) - coalesce(n_kept, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN o USING (doc_id) LEFT JOIN h USING (doc_id)
""")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return line_report(table(spark, sf, "documents"))


@query("op10_hidden_markov")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"), bucket(F.col("doc_id"), 7) == 2)


@query("op1_minhash")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), words=2)


_VECTORS = """
v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
      FROM (SELECT DISTINCT * FROM embeddings) WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
"""


@query("op13_hard_negatives", f"""
WITH {_VECTORS.strip()},
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
""")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    vec, label = F.col("vec_id"), F.col("label")
    rows = usable_vectors(table(spark, sf, "embeddings"), label=F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine_hard_negatives(rows, rows.filter(F.col("id") % 50 == 0))


def _edits_sql() -> str:
    """Rows of the edit table: initial, state before, inserted turns and edit, cost, state after (n nothing, s, u, a)."""
    after = {"n": "u", "s": "u", "u": "a", "a": "u"}
    rows = []
    for initial in "sua?":
        for state in after:
            rows.append((initial, state, "D", 2, state, ""))
            at, said = state, ""
            for inserted in range(3):
                if initial == after[at] or (initial == "s" and at == "n"):
                    rows.append((initial, state, "I" * inserted + "K", 5 * inserted, initial, said))
                rows.append((initial, state, "I" * inserted + "R", 5 * inserted + 1, after[at], said))
                at = after[at]
                said += {"u": "user:", "a": "assistant:"}[at] + "|"
    return ", ".join(str(r) for r in rows)


@query("op12_conversation_repair", f"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), n)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b
      FROM conversations),
c AS (SELECT k.*, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS lot FROM k, bits),
d AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
             CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE lot <> 0),
o AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
             lag(role[1]) OVER w AS before FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
             count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (i > 1 AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
e(initial, state, edit, price, after, said) AS (VALUES {_edits_sql()}),
p AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 'n' AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS said FROM g
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.audit, best.said FROM (
    SELECT p.conv_id, f.i, e.after AS state, min({{'cost': p.cost + e.price + CASE WHEN fault = 't' AND e.edit <> 'D' THEN 5 ELSE 0 END, 'audit': p.audit || e.edit,
      'said': CASE WHEN e.edit = 'D' THEN p.said ELSE list_concat(p.said, list_filter(string_split(e.said, '|'), lambda x: x <> ''),
        [CASE WHEN e.edit[-1] = 'K' THEN f.role WHEN e.after = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text]) END}}) AS best
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
    JOIN e ON e.state = p.state AND e.initial = CASE WHEN f.role[1] IN ('s', 'u', 'a') THEN f.role[1] ELSE '?' END AND (e.edit = 'D' OR fault NOT IN ('b', 'd'))
    GROUP BY p.conv_id, f.i, e.after)),
t AS (SELECT p.conv_id, min({{'cost': cost + CASE state WHEN 's' THEN 10 WHEN 'u' THEN 5 ELSE 0 END, 'audit': audit || CASE state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END,
        'said': list_concat(said, CASE state WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE [] END)}}) AS best
      FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.n = p.i GROUP BY p.conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    return repair_report(damage(rows), rows.select(F.col("conv_id").alias("conv")))


@query("op11_order_minhash")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint_report(table(spark, sf, "documents"))
