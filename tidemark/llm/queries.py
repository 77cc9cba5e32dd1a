"""The operators of this subpackage as registered queries, with SQL where SQL can ask the same question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.near_dedup import near_duplicates

    return near_duplicates(_documents(spark, sf))


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.decontamination import verbatim_matches

    found = verbatim_matches(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0)).cast("long")
    found = found.withColumn("items", items)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), longest.alias("longest"))


@query("op6_packing")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.packing import pack

    pieces = pack(_documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


_OP8_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op8_line_dedup", _OP8_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.line_dedup import without_shared_lines

    kept = without_shared_lines(_documents(spark, sf).select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@query("op10_lm_scoring")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.lm_scoring import score

    return score(_documents(spark, sf), F.crc32(F.col("doc_id").cast("string")) % 5 == 1)


_OP4_SQL = """
WITH bits AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, encode(coalesce(text, '')) AS raw FROM documents
), sized AS (
    SELECT doc_id, size, CASE WHEN size = 16 THEN 0 ELSE xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(8 * (size - 16)), lambda i: get_bit(raw::BIT, (i - i % 8 + 7 - i % 8)::INT)::BIGINT)),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) END AS text_crc32
    FROM bits
), laid AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total
    FROM sized
), placed AS (
    SELECT *, least(39, (2 * before + size) * 40 // (2 * total)) AS shard FROM laid
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM placed
"""


@query("op4_sharding", _OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.sharding import byte_shards

    placed = byte_shards(_documents(spark, sf))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_fingerprints")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.fingerprints import edited_fingerprints

    return edited_fingerprints(_documents(spark, sf))


@query("op7_pii")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.personal_data import KINDS, personal_data

    found = personal_data(_documents(spark, sf))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, KINDS), F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op3_language_id")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.language import predict

    return predict(_documents(spark, sf), F.crc32(F.col("doc_id").cast("string")) % 4 == 2)


@query("op5_toxicity")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.toxicity import score

    return score(_documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.simhash import near_duplicates

    return near_duplicates(_documents(spark, sf))


_OP12_SQL = r"""
WITH texts AS (
    SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark
), worded AS (
    SELECT side, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
), featured AS (
    SELECT side, id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature
    FROM worded
), counted AS (
    SELECT side, id, feature, count(*) AS n FROM featured GROUP BY ALL
), bits AS (
    SELECT feature, encode(feature)::BIT AS bit, 8 * octet_length(encode(feature)) AS size FROM (SELECT DISTINCT feature FROM counted)
), hashed AS (
    SELECT feature, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(size), lambda i: get_bit(bit, (i - i % 8 + 7 - i % 8)::INT)::BIGINT)),
               lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 10000 AS bucket
    FROM bits
), sums AS (
    SELECT bucket, sum(n) FILTER (WHERE side = 'd') AS s, sum(n) FILTER (WHERE side = 'b') AS t
    FROM counted JOIN hashed USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                   / ((coalesce(s, 0) + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
    FROM sums
), weights AS (
    SELECT id, sum(n)::BIGINT AS n, floor(sum(n * gain) / sum(n))::BIGINT AS weight
    FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
    SELECT w.id, len(words) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM worded w LEFT JOIN weights x ON x.id = w.id WHERE side = 'd'
), placed AS (
    SELECT id, row_number() OVER (ORDER BY score DESC, id) AS place, count(*) OVER () AS total FROM scored WHERE n_words >= 20
)
SELECT s.id AS doc_id, n_features, weight, score, CASE WHEN place <= 25 * total // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON p.id = s.id
"""


@query("op12_importance_resampling", _OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm.resampling import resampled

    return resampled(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query("op11_tokenizer_alignment")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.alignment import aligned

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return aligned(_documents(spark, sf), *paths, digest=True).withColumnRenamed("groups", "groups_sha256")


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
