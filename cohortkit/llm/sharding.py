"""Sharding by extendible hashing.

A document's bucket is a prefix of the 60 bits of its id's hash.  The
directory starts with one bucket; only a bucket above the byte limit splits
on another bit, until every shard fits.  Instead of splitting one bit a job,
one aggregation sums the bytes of all prefixes of a chosen number of bits;
rolled up, these sums give every bucket of every depth, and a document's shard
is its shortest prefix that fits.  Cells that are too large even at that number
of bits - and only they - are counted again with more bits.

Bits: enough for the mean shard and three more, so a directory has about 8 to
16 cells a shard.  It is broadcast up to ``BROADCAST_CELLS`` cells, and joined
by a shuffle of the documents beyond.

A bucket with one id alone can't split.  If it is one document above the limit,
it is a shard of its own.  Rows that share an id go to numbered overflow pages
of that bucket: rows above half the limit have a page each, the others fill
pages in order of size, so all pages fit.

Native; nothing is collected but totals.  Defined results: a null text has 0
bytes, a null id hashes as the empty text, an empty table gives no rows, equal
rows are kept.  Only the named columns are read by ``assign``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written
from cohortkit.operators.windows import prefix_sums

__all__ = ["assign", "directory", "attach", "paged", "HASH_BITS"]

HASH_BITS = 60

#: Cells (three short numbers each) up to which the directory is broadcast: about 60 MB.
BROADCAST_CELLS = 1_000_000


def id_hash(key: Column) -> Column:
    """The first 60 bits of the md5 sum of the id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def text_bytes(text: Column) -> Column:
    """The bytes a text counts for."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, HASH_BITS - bits) if bits else F.lit(0).cast("long")


def directory(rows: DataFrame, limit: int, spare_bits: int = 3) -> list[tuple[int, DataFrame]]:
    """Directories (bits, cells) for ``rows`` (hash, n_bytes): a cell has its
    prefix of ``bits`` bits, the ``depth`` of its shard, the shard's bytes and
    rows, and whether it is one id above the limit (``single``).  A cell without
    a row is looked up in the next directory."""
    out, done, open_rows = [], 0, rows
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    need = total
    while True:
        bits = min(HASH_BITS, done + max(0, math.ceil(math.log2(max(1.0, need / limit)))) + spare_bits)
        cells = open_rows.groupBy(_prefix(F.col("hash"), bits).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        cells = written(cells, "cells")
        from_depth = done + 1 if out else 0
        nodes = cells.withColumn("depth", F.explode(F.sequence(F.lit(from_depth), F.lit(bits))))
        nodes = nodes.withColumn("node", F.expr(f"shiftright(cell, {bits} - depth)"))
        sums = nodes.groupBy("depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.min("low").alias("low"), F.max("high").alias("high"))
        single = F.col("low") == F.col("high")
        fits = sums.where((F.col("shard_bytes") <= limit) | single).select(
            "depth", "node", "shard_bytes", "shard_docs", (single & (F.col("shard_bytes") > limit)).alias("single"))
        leaf = F.min_by(F.struct("depth", "shard_bytes", "shard_docs", "single"), F.col("depth"))
        found = nodes.select("cell", "depth", "node").join(fits, ["depth", "node"]).groupBy("cell").agg(leaf.alias("leaf")).select("cell", "leaf.*")
        found = written(found, "directory")
        out.append((bits, found))
        over = cells.join(found, "cell", "left_anti")
        need = over.agg(F.max("bytes")).first()[0]
        if need is None or bits == HASH_BITS:
            return out
        open_rows = open_rows.join(over.select("cell"), _prefix(F.col("hash"), bits) == F.col("cell"), "left_semi")
        done = bits


def attach(rows: DataFrame, cells: list[tuple[int, DataFrame]], h: Column) -> DataFrame:
    """``rows`` with ``shard`` (its bits as text), ``depth``, ``shard_bytes``,
    ``shard_docs`` and ``single``; ``h``: the id's hash."""
    out, leaf = rows.withColumn("__hash", h), None
    for k, (bits, found) in enumerate(cells):
        side = found.select(F.col("cell").alias(f"__cell{k}"), F.struct("depth", "shard_bytes", "shard_docs", "single").alias(f"__leaf{k}"))
        side = F.broadcast(side) if found.count() <= BROADCAST_CELLS else side
        out = out.join(side, _prefix(F.col("__hash"), bits) == F.col(f"__cell{k}"), "left")
        leaf = F.col(f"__leaf{k}") if leaf is None else F.coalesce(leaf, F.col(f"__leaf{k}"))
    out = out.withColumn("__leaf", leaf)
    bit_text = F.lpad(F.bin("__hash"), HASH_BITS, "0")
    return out.select(*rows.columns, F.substring(bit_text, F.lit(1), F.col("__leaf.depth")).alias("shard"), "__leaf.depth", "__leaf.shard_bytes", "__leaf.shard_docs", "__leaf.single")


def paged(rows: DataFrame, cells: list[tuple[int, DataFrame]], h: Column, limit: int) -> DataFrame:
    """``attach`` for ``rows`` with their bytes (``n_bytes``), with overflow
    pages where a bucket of one id has more rows than fit: ``shard`` is the
    bucket and the page, the shard's bytes and rows are the page's.  Then
    ``single`` is left for one row above the limit."""
    got = attach(rows, cells, h)
    over = F.col("single") & (F.col("shard_docs") > 1)
    if not any(found.where(over).limit(1).count() for _, found in cells):
        return got
    # only rows of such buckets are written, with a number that holds; pages are dealt on their sizes alone
    crowd = written(got.where(over).withColumn("__tie", F.monotonically_increasing_id()), "crowd")
    small = F.when(F.col("n_bytes") * 2 <= limit, F.col("n_bytes")).otherwise(0)
    large = (F.col("n_bytes") * 2 > limit).cast("long")
    sizes = prefix_sums(crowd.select("shard", "n_bytes", "__tie"), ["shard"], ["n_bytes", "__tie"], {"before": small, "nth": large}, inclusive=False)
    page = F.when(F.col("n_bytes") * 2 > limit, F.concat(F.lit("L"), F.col("nth"))).otherwise(F.concat(F.lit("P"), F.floor(F.col("before") * 2 / limit)))
    pages = written(sizes.select("__tie", "n_bytes", F.concat("shard", F.lit("."), page).alias("shard")), "pages")
    sums = pages.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    said = pages.select("__tie", "shard").join(sums, "shard").withColumn("single", F.col("shard_bytes") > limit)
    return got.where(~over).unionByName(crowd.drop("shard", "shard_bytes", "shard_docs", "single").join(said, "__tie").select(*got.columns))


def assign(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id, ``n_bytes``, ``shard``, ``depth``,
    and the shard's ``shard_bytes`` and ``shard_docs``."""
    rows = written(docs.select(F.col(id_col), id_hash(F.col(id_col)).alias("hash"), text_bytes(F.col(text_col)).alias("n_bytes")), "bytes")
    return paged(rows, directory(rows, limit), F.col("hash"), limit).select(id_col, "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")
