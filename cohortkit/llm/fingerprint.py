"""Document fingerprints from closed syncmers.

Symbols are runs of non-blank characters, cut every 16 code points, so texts
without blanks work too.  A k-mer of symbols is an anchor if the least hash
among its inner s-mers is that of the first or the last one.  That depends on
the k-mer alone, not on its surroundings: an edit moves or removes only the
anchors it touches.  An anchor has a position and the hash of its k-mer, so
anchors of two texts can be matched by hash and compared by position.

The fingerprint is the 64 least distinct anchor hashes, in text order, as hex
digits.  Likeness of two fingerprints: among the 64 least hashes of both, the
share that both hold (an unbiased estimate of the Jaccard likeness of the
anchors).  Native: arrays and higher-order functions only, one row at a time.

Defined results: null is the empty text; a text of fewer than k symbols, but
not none, is one anchor; the empty text has no anchor, an empty fingerprint,
likeness 1 with itself and 0 with others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import running_sum, written

__all__ = ["anchors", "sketch", "as_text", "likeness", "with_next"]

#: Symbols in a k-mer and in its inner s-mers; hashes in a fingerprint.
K, S, KEEP = 8, 2, 64


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Array of (pos, hash): the closed syncmers of a text in order."""
    symbols = F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,16}"), F.lit(0))
    h = F.transform(symbols, lambda w: F.xxhash64(w))
    return F.transform(F.array(h), lambda h: _closed(h, k, s))[0]  # one evaluation of h


def _closed(h: Column, k: int, s: int) -> Column:
    # single elements are read with get(): slice() costs the whole array each time
    window = k - s + 1

    def found(inner: Column) -> Column:
        marked = F.transform(inner, lambda x, i: F.when(
            (i + window <= F.size(inner)) & (F.least(x, *[F.get(inner, i + j) for j in range(1, window)]) == F.least(x, F.get(inner, i + (window - 1)))),
            F.struct(i.alias("pos"), F.xxhash64(*[F.get(h, i + j) for j in range(k)]).alias("hash"))))
        return F.filter(marked, lambda a: a.isNotNull())

    inner = F.transform(h, lambda x, i: F.when(i + s <= F.size(h), F.xxhash64(x, *[F.get(h, i + j) for j in range(1, s)])))
    inner = F.filter(inner, lambda x: x.isNotNull())
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(h).alias("hash")))
    return F.when(F.size(h) >= k, F.transform(F.array(inner), found)[0]).when(F.size(h) > 0, whole).otherwise(F.slice(whole, 1, 0))


def sketch(text: Column, keep: int = KEEP) -> Column:
    """The ``keep`` least distinct anchor hashes, in text order."""
    def least(hashes: Column) -> Column:
        last = F.element_at(F.slice(F.sort_array(hashes), 1, keep), -1)
        return F.transform(F.array(last), lambda last: F.filter(hashes, lambda x: x <= last))[0]  # sorts once

    hashes = F.array_distinct(F.transform(anchors(text), lambda a: a["hash"]))
    return F.transform(F.array(hashes), lambda x: F.when(F.size(x) <= keep, x).otherwise(least(x)))[0]


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column, keep: int = KEEP) -> Column:
    """Likeness (0 to 1) of two sketches."""
    either = F.slice(F.sort_array(F.array_union(a, b)), 1, keep)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), either))
    return F.when(F.size(either) == 0, 1.0).otherwise(shared / F.size(either))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``id``, ``text`` (null: empty), ``n_chars``, and
    of the next document by descending id (after the last: the first)
    ``next_id``, ``next_head``, its first floor(n_chars / 2) code points, and
    ``next_sketch``.  Null ids come last; rows of one id follow by a hash of the text;
    rows equal in id and text have the same next document: the next that differs
    (a lone document is its own).

    Order and sizes come from narrow columns; the whole texts are shuffled
    once, and only the heads that are needed a second time."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"key": F.xxhash64("id"), "hash": F.xxhash64("text")})
    each = rows.groupBy("id", "key", "hash").agg(F.count(F.lit(1)).alias("rows"), F.first(F.length("text")).alias("n_chars"))
    ranked = written(running_sum(written(each, "ids"), [F.col("id").desc_nulls_last(), F.col("hash")], F.lit(1).cast("long"), "place"), "order")
    n = ranked.count()
    before = ranked.select(F.pmod(F.col("place") + 1, F.lit(max(n, 1))).alias("place"), F.col("key").alias("to_key"), F.col("hash").alias("to_hash"), F.floor(F.col("n_chars") / 2).cast("int").alias("need"))
    chain = written(ranked.select("place", "key", "hash", "rows").join(before, "place").drop("place"), "chain")
    # the next id goes along, so that both readings of the texts share one shuffle
    sent = ["to_key", "to_hash", F.col("id").alias("next_id"), F.substring(F.col("text"), F.lit(1), F.col("need")).alias("next_head"), sketch(F.col("text")).alias("next_sketch")]
    heads = rows.join(chain.where("rows = 1"), ["key", "hash"]).select(*sent)
    alike = chain.where("rows > 1")
    if alike.limit(1).count():
        heads = heads.unionByName(rows.join(alike, ["key", "hash"]).dropDuplicates(["key", "hash"]).select(*sent))
    got = rows.join(heads, (F.col("key") == F.col("to_key")) & (F.col("hash") == F.col("to_hash")))
    return got.select("id", "text", F.length("text").cast("long").alias("n_chars"), "next_id", "next_head", "next_sketch")
