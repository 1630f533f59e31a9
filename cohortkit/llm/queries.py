"""The queries of this subpackage: each applies one operator with production
parameters to its whole table.  ``SQL`` holds DuckDB SQL where SQL can express
the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import decontaminate, fingerprint, license_scan, line_dedup, mixing, near_dedup, pair_bitmaps, quality, sharding, suffix_tree, token_shards, whitening, wrappers
from cohortkit.llm.common import table

#: Bytes of a shard: of the query, small enough to split the smallest tables, and of the pipeline.
QUERY_SHARD_BYTES, SHARD_BYTES = 1 << 20, 64 << 20
PIPELINE_SHARD_BYTES = SHARD_BYTES

#: Public byte-level BPE ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Tokenizers A and B of the alignment.
TOKENIZER_A, TOKENIZER_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"

#: What counts as a good document for the classifier.
GOOD = "quality = 1 and toxic = 0"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allocate(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    return license_scan.scan(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang", "doc_id"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are kept."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), GOOD, columns=["doc_id", "source", "lang"])


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) == 0
    tree, counts = suffix_tree.train(docs.where(~F.coalesce(held_out, F.lit(False))))
    return suffix_tree.score(docs, tree, counts).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(table(spark, sf_dir, "documents"), VOCABULARY)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.with_next(table(spark, sf_dir, "documents"))
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 2)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), kept.cast("int")), F.col("next_head"))
    rows = rows.select("id", "n_chars", F.sha2(edited, 256).alias("edited_sha256"), fingerprint.sketch(F.col("text")).alias("own"), fingerprint.sketch(edited).alias("other"), "next_sketch", "next_id")
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprint.as_text(F.col("own")).alias("fingerprint"), fingerprint.as_text(F.col("other")).alias("edited_fingerprint"),
                       fingerprint.likeness(F.col("own"), F.col("other")).alias("near_edited"), fingerprint.likeness(F.col("own"), F.col("next_sketch")).alias("near_next"), F.col("next_id").alias("next_doc_id"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.marks(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), QUERY_SHARD_BYTES)


def op11_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bitmaps.align(table(spark, sf_dir, "documents"), TOKENIZER_A, TOKENIZER_B)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_mixing": op2_mixing, "op3_license_scan": op3_license_scan, "op4_quality": op4_quality, "op5_suffix_tree": op5_suffix_tree, "op6_token_shards": op6_token_shards,
           "op7_near_dedup": op7_near_dedup, "op8_fingerprint": op8_fingerprint, "op9_line_dedup": op9_line_dedup, "op10_sharding": op10_sharding,
           "op11_wrappers": op11_wrappers, "op12_pair_bitmaps": op12_pair_bitmaps, "op13_whitening": op13_whitening}

SQL = {
    "op1_decontaminate": r"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, places.n, i, item FROM places JOIN windows USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op10_sharding": f"""
WITH docs AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes FROM documents),
cells AS (SELECT doc_id, n_bytes, h, d AS depth, h >> (60 - d) AS node FROM docs, (SELECT unnest(generate_series(0, 60)) AS d)),
nodes AS (SELECT depth, node, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs FROM cells GROUP BY depth, node HAVING sum(n_bytes) <= {QUERY_SHARD_BYTES} OR count(DISTINCT h) = 1),
leaf AS (SELECT doc_id, n_bytes, h, min(depth) AS depth FROM cells JOIN nodes USING (depth, node) GROUP BY doc_id, n_bytes, h)
SELECT doc_id, n_bytes, CASE WHEN leaf.depth = 0 THEN '' ELSE substr(lpad(bin(h), 60, '0'), 1, leaf.depth::INT) END AS shard, CAST(leaf.depth AS INTEGER) AS depth,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs
FROM leaf JOIN nodes ON nodes.depth = leaf.depth AND nodes.node = h >> (60 - leaf.depth)""",
}
