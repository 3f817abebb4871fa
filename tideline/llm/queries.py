"""The registered queries of the numbered operators, and the SQL that gives their rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import align, bpe, chat, exact_dedup, langid, minhash, mixing, quality, simhash, spelling, suffix_dedup, tokcount, topk
from tideline.llm.common import table

try:  # vocabulary files of public tokenizers, where they are installed
    import public_tokenizers
except ImportError:
    public_tokenizers = None


def ranks_file() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def alignment_files() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), *ranks_file())


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = ranks_file()
    return tokcount.document_tokens(table(spark, sf_dir, "documents"), ranks, pattern, end_id=50256)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 toxic, 1 clean but of low quality, 2 clean and good; a document is kept if 2 is the likelier."""
    docs = table(spark, sf_dir, "documents")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    model = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade")), n_grades=3)
    return quality.score(docs, model).withColumn("kept", F.col("p_top") >= 0.5)


TRICKY = r"\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    return chat.read_back(chat.format_trees(chat.linear_tree(rows.unionByName(tricky))))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align.align_documents(table(spark, sf_dir, "documents"), *alignment_files())
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    scored = align.score_links(rows.withColumn("groups_sha256", digest).drop("groups"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


OP6_SQL = """
WITH n AS MATERIALIZED (SELECT row_number() OVER () AS no, vec_id, embedding FROM embeddings),
v AS MATERIALIZED (
  SELECT no, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM n
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.no, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.no <> b.no AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, 4 + length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + 2 + length(regexp_replace(text, '[\\#<]', 'xx', 'g')) + 9 AS chars FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(body) DESC, doc_id) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS x FROM w WHERE len(w) > 0
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a, b FROM (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS k FROM s JOIN s t ON s.x = t.x AND s.doc_id <> t.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)
), reach AS (SELECT doc_id AS a, doc_id AS node FROM documents UNION SELECT r.a, p.b FROM reach r JOIN p ON r.node = p.a),
c AS (SELECT a, min(node) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP12_SQL = r"""
WITH RECURSIVE crc AS (  -- the checksum's table of 256 remainders
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL
), bytes AS (
  SELECT run, k, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END)) AS b FROM runs WHERE length(run) >= 5
), summed AS (
  SELECT run, k, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, x: xor(t[CAST((xor(c, x) & 255) + 1 AS INTEGER)], c >> 8)), 4294967295) AS h FROM bytes, crc
), words AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n
  FROM summed GROUP BY 1 HAVING length(word) >= 5 AND sum(k) >= 3
), cut AS MATERIALIZED (
  SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)
), near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS v, b.n AS vn FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, v, vn, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY vn DESC, v) AS r FROM near
), forms AS MATERIALIZED (
  SELECT w.word, w.n, CASE WHEN b.vn >= 2 * w.n THEN b.v END AS form, CASE WHEN b.vn >= 2 * w.n THEN b.vn END AS form_n, coalesce(n_near, 0) AS n_near
  FROM words w LEFT JOIN best b ON w.word = b.word AND b.r = 1
), way AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT y.word, f.form FROM way y JOIN forms f ON y.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, y.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN way y ON f.word = y.word JOIN forms e ON y.at = e.word AND e.form IS NULL
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_byte_bpe, op2_mix_sources, op3_language_id, op4_token_counts, op5_suffix_dedup, op6_top_k, op7_exact_dedup, op8_quality, op9_chat, op10_simhash, op11_minhash, op12_spelling, op13_align)}


def oracle_sql() -> dict[str, str]:
    return {"op6_top_k": OP6_SQL, "op7_exact_dedup": OP7_SQL, "op9_chat": OP9_SQL, "op11_minhash": OP11_SQL, "op12_spelling": OP12_SQL}
