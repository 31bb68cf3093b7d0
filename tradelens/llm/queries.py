"""Queries over the corpus tables, one for each numbered operator, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tradelens.llm.ann import nearest
from tradelens.llm.common import crc_mod, table
from tradelens.llm.conversations import damaged, repair_reports
from tradelens.llm.decontaminate import contained_items
from tradelens.llm.html_extract import main_text
from tradelens.llm.lm_score import lm_scores
from tradelens.llm.near_dedup import near_duplicates
from tradelens.llm.packing import packed_sequences
from tradelens.llm.phrases import collocations
from tradelens.llm.quality import fit_quality, quality_scores
from tradelens.llm.search import top_k
from tradelens.llm.sharding import extendible_shards
from tradelens.llm.token_files import token_files
from tradelens.llm.toxicity import fit_toxicity, toxicity_scores

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x20\x09-\x0D]+')" % (UPPER, LOWER)


def labelled(spark: SparkSession, sf_dir: str, label: str, n: int = 0, held: int = 0) -> tuple[DataFrame, DataFrame]:
    """Documents and the rows of one label; with ``n``, only rows whose crc32(doc_id as text) mod n is not ``held``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    return table(spark, sf_dir, "documents"), labels.where(crc_mod(F.col("doc_id"), n) != held) if n else labels


def _verdicts(scores: DataFrame, n: int, held: int) -> DataFrame:
    out = scores.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), n) == held, F.lit(False)))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = fit_toxicity(*labelled(spark, sf_dir, "toxic", 4, 2))
    scores = toxicity_scores(table(spark, sf_dir, "documents"), net)
    return _verdicts(scores, 4, 2).select("doc_id", "held_out", "score", "predicted", "n_windows")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_quality(*labelled(spark, sf_dir, "quality", 5, 0))
    scores = quality_scores(table(spark, sf_dir, "documents"), model)
    return _verdicts(scores, 5, 0).select("doc_id", "held_out", "score", "predicted")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    scores = lm_scores(docs, docs.where(~held_out)).withColumn("held_out", held_out)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound"]
    return packed_sequences(table(spark, sf_dir, "documents")).select(*columns)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 10)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_shards(table(spark, sf_dir, "documents"))


def op11_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every hundredth id, by Euclidean distance; empty where no vector is valid."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage by crc32; conversations that lose all rows get zeros."""
    return repair_reports(damaged(table(spark, sf_dir, "conversations")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language; languages without a phrase that occurs 30 times have none."""
    return collocations(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
u AS (SELECT doc_id, unnest(sh) AS x FROM s),
c AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS both_n FROM u p JOIN u q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * both_n >= 85 * (na.n_shingles + nb.n_shingles - both_n)),
r AS (SELECT doc_id AS a, doc_id AS z FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.z = e.a),
k AS (SELECT a, min(z) AS component_id FROM r GROUP BY a)
SELECT n.doc_id, n.n_shingles, k.component_id, n.doc_id = k.component_id AS kept FROM n JOIN k ON k.a = n.doc_id
"""

SHINGLES = """CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END"""

OP5_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents), b AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
ds AS (SELECT doc_id, unnest({SHINGLES}) AS x FROM d), bl AS (SELECT item_id, {SHINGLES} AS sh FROM b),
bs AS (SELECT item_id, CAST(len(sh) AS BIGINT) AS n_item, unnest(sh) AS x FROM bl)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM ds JOIN bs USING (x) GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item
"""

OP8_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings),
p AS (SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id,
        CAST(len(list_filter(range(1, len(e.code) + 1), lambda i: e.code[i] <> q.code[i])) AS BIGINT) AS distance
      FROM e, e q WHERE q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id)
SELECT query_id, neighbor_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
FROM p QUALIFY rank <= 10
"""

OP12_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
d AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(k)), lambda i: CAST(ord(k[i + 1]) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS f FROM k, crc),
l AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy FROM d WHERE f <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS body FROM l),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
h AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS r FROM g),
n AS (SELECT conv_id, i, role, text, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN upper(r) ELSE r END AS symbol FROM h),
c AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM h GROUP BY 1),
nxt(q, r, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(q, q1, edits, turns) AS (SELECT q, q, '', CAST([] AS VARCHAR[]) FROM (VALUES (0), (1), (2), (3)) v(q) UNION ALL SELECT ins.q, q2, edits || 'I', list_append(turns, CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END) FROM ins JOIN nxt ON nxt.q = q1 AND r <> 's' WHERE length(edits) < 3),
symbols(symbol) AS (VALUES ('s'), ('u'), ('a'), ('o'), ('S'), ('U'), ('A'), ('O'), ('x')),
ops AS (SELECT symbol, q, q AS q2, 4 AS cost, 'D' AS edit, '' AS due FROM symbols, (VALUES (0), (1), (2), (3)) v(q)
  UNION ALL SELECT symbol, q, q2, CASE WHEN symbol = upper(symbol) THEN 3 ELSE 0 END, 'K', '' FROM symbols JOIN nxt ON r = lower(symbol)
  UNION ALL SELECT symbol, q, q2, CASE WHEN symbol = upper(symbol) THEN 6 ELSE 3 END, 'R', CASE r WHEN 'u' THEN 'user' ELSE 'assistant' END FROM symbols JOIN nxt ON r <> 's' WHERE symbol <> 'x'),
steps AS (SELECT symbol, ins.q, q2, 3 * length(edits) + cost AS cost, edits || edit AS edits, edit, due, turns FROM ins JOIN ops ON ops.q = ins.q1),
w AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'cost': CAST(0 AS BIGINT), 'audit': '', 'turns': CAST([] AS VARCHAR[])} AS best FROM conversations
  UNION ALL SELECT w.conv_id, n.i, q2, min({'cost': best.cost + cost, 'audit': best.audit || edits, 'turns': list_concat(best.turns, steps.turns, CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [due || ':' || text] END)})
  FROM w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.i = w.i + 1 JOIN steps ON steps.q = w.q AND steps.symbol = n.symbol GROUP BY 1, 2, 3),
e AS (SELECT w.conv_id, min({'cost': best.cost + [0, 6, 3, 0][q + 1], 'audit': best.audit || ['', 'II', 'I', ''][q + 1], 'turns': list_concat(best.turns, [[], ['user:', 'assistant:'], ['assistant:'], []][q + 1])}) AS best
  FROM w LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE i = coalesce(c.rows, 0) GROUP BY 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit, sha256(array_to_string(best.turns, chr(10))) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '%s', '%s'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, words, unnest(list_transform(range(1, len(ws) - words + 2), lambda i: array_to_string(ws[i:i + words - 1], ' '))) AS phrase FROM w, range(1, 5) v(words)),
f AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS c FROM g GROUP BY ALL),
t AS MATERIALIZED (SELECT lang, phrase, c FROM f WHERE c >= 30),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY 1),
c AS (SELECT lang, words, phrase, c AS a, string_split(phrase, ' ') AS s FROM f WHERE c >= 30 AND words > 1),
m AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(s[1:k], ' ') AS first, array_to_string(s[k + 1:], ' ') AS rest FROM c JOIN range(1, 4) v(k) ON k < words),
k AS (SELECT m.lang, m.phrase, a, k, l.c AS l, r.c AS r, CAST(2000000 * CAST(a AS HUGEINT) // (CAST(l.c AS HUGEINT) + r.c) AS BIGINT) AS score
  FROM m JOIN t l ON l.lang = m.lang AND l.phrase = first JOIN t r ON r.lang = m.lang AND r.phrase = rest),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, a, unnest(list_transform(range(1, words - size + 2), lambda i: array_to_string(s[i:i + size - 1], ' '))) AS phrase FROM c JOIN range(2, 4) v(size) ON size < words),
h AS (SELECT lang, phrase, max(a) AS most FROM i GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM b JOIN n USING (lang) LEFT JOIN h USING (lang, phrase) WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT) QUALIFY rank <= 2000
""" % (UPPER, LOWER)

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_html_text": op3_html_text,
    "op4_lm_score": op4_lm_score,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_near_dedup": op7_near_dedup,
    "op8_top_k": op8_top_k,
    "op9_token_files": op9_token_files,
    "op10_sharding": op10_sharding,
    "op11_ann": op11_ann,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_collocations": op13_collocations,
}
ORACLES = {"op5_decontamination": OP5_SQL, "op7_near_dedup": OP7_SQL, "op8_top_k": OP8_SQL, "op12_conversation_repair": OP12_SQL, "op13_collocations": OP13_SQL}
