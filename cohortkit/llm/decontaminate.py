"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are the lower-cased runs of letters, digits and non-ASCII characters.
Every ``n`` consecutive words of a benchmark item form a window; an item of
fewer words, but not none, is one window.  Tasks scan the whole texts of
documents, look every window hash up in the broadcast set, verify each hit
word by word, and report or remove what was hit.

The broadcast is bounded: the benchmark is dealt into blocks of at most
``block_bytes`` of text (one item may exceed it alone), and the documents are
scanned once for each block, so no broadcast grows with the benchmark.

Defined results: a null or empty text has no words and is clean; null item ids
count as windows, but aren't listed; an item that stands twice in the
benchmark counts once by its id; repeated documents give a row each; an
empty benchmark leaves all documents clean.  Only the columns named are read,
so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import words as W

__all__ = ["scan", "decontaminate"]

#: Benchmark text that one broadcast set is built from.
BLOCK_BYTES = 64 << 20

_FILTER_BITS = 20


class Windows:
    """The windows of one block: per length, sorted hashes, and a dictionary
    from the window's words to the ids of the items that hold it."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        data, offsets = W.utf8(pa.array([t for _, t in items], pa.string()))
        start, end, row = W.find_words(data, offsets, W.ALNUM)
        hashes = W.hash_words(data, start, end)
        low = W.LOWER[data].tobytes()
        found: dict[int, set[int]] = {}
        self.ids: dict[bytes, set[str]] = {}
        bounds = np.searchsorted(row, np.arange(len(items) + 1))
        for i, (item, _) in enumerate(items):
            a, b = int(bounds[i]), int(bounds[i + 1])
            size = min(n, b - a)
            if size == 0:
                continue
            found.setdefault(size, set()).update(W.hash_ngrams(hashes[a:b], size).tolist())
            for k in range(a, b - size + 1):
                ids = self.ids.setdefault(_joined(low, start, end, k, size), set())
                if item is not None:
                    ids.add(item)
        self.hashes = {size: np.array(sorted(h), dtype=np.uint64) for size, h in sorted(found.items())}
        self.filters = {}
        for size, h in self.hashes.items():
            self.filters[size] = np.zeros(1 << _FILTER_BITS, dtype=bool)
            self.filters[size][(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, set[str]]]:
        """Start, end and row of the words, which of them are hit, and the
        items hit by row."""
        start, end, row = W.find_words(data, offsets, W.ALNUM)
        hashes = W.hash_words(data, start, end)
        turns, items, low = np.zeros(len(start) + 1, dtype=np.int32), {}, None
        for size, known in self.hashes.items():
            h = W.hash_ngrams(hashes, size)
            at = np.flatnonzero(self.filters[size][(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            at = at[row[at] == row[at + size - 1]]
            at = at[known[np.minimum(np.searchsorted(known, h[at]), len(known) - 1)] == h[at]]
            if len(at) and low is None:
                low = W.LOWER[data].tobytes()
            for k in at.tolist():
                ids = self.ids.get(_joined(low, start, end, k, size))
                if ids is not None:
                    turns[k] += 1
                    turns[k + size] -= 1
                    items.setdefault(int(row[k]), set()).update(ids)
        return start, end, row, np.cumsum(turns[:-1]) > 0, items


def _joined(low: bytes, start: np.ndarray, end: np.ndarray, k: int, size: int) -> bytes:
    return b" ".join(low[start[j] : end[j]] for j in range(k, k + size))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The benchmark's (id as text, text) rows, block by block."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for b in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        yield [(r.item, r.text) for r in block.collect()]  # at most about block_bytes


def _spans(start: np.ndarray, end: np.ndarray, row: np.ndarray, hit: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Runs of hit words: row, first word, word after the last, byte range."""
    if not hit.any():
        return []
    k = np.flatnonzero(hit)
    cut = np.flatnonzero((np.diff(k) > 1) | (np.diff(row[k]) > 0))
    first, last = k[np.r_[0, cut + 1]], k[np.r_[cut, len(k) - 1]]
    return list(zip(row[first].tolist(), first.tolist(), (last + 1).tolist(), start[first].tolist(), end[last].tolist()))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         bench_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document: its id, ``n_words``, ``n_hit`` (words inside
    any occurrence of a window), ``items`` (ids as text, sorted) and ``spans``
    (runs of hit words: first word, word after the last)."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"), F.monotonically_increasing_id().alias("__row"))
    kind = source.schema[id_col].dataType.simpleString()
    parts = []
    for items in _blocks(benchmark, item_col, bench_text_col, block_bytes):
        sent = spark.sparkContext.broadcast(Windows(items, n))

        def look(batches, sent=sent):
            windows = sent.value
            for batch in batches:
                data, offsets = W.utf8(batch.column(1))
                for i, j in W.slices(offsets):
                    start, end, row, hit, hits = windows.scan(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    first = np.searchsorted(row, np.arange(j - i + 1))
                    spans: list[list] = [[] for _ in range(j - i)]
                    for r, a, b, _, _ in _spans(start, end, row, hit):
                        spans[r].append({"first": a - int(first[r]), "until": b - int(first[r])})
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i), pa.array(np.diff(first)), pa.array(np.bincount(row[hit], minlength=j - i)),
                         pa.array([sorted(hits.get(r, ())) for r in range(j - i)], pa.list_(pa.string())),
                         pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("until", pa.int64())]))), batch.column(2).slice(i, j - i)],
                        [id_col, "n_words", "n_hit", "items", "spans", "__row"])

        parts.append(source.mapInArrow(look, f"`{id_col}` {kind}, n_words long, n_hit long, items array<string>, spans array<struct<first:long,until:long>>, __row long"))
    if len(parts) == 1:
        return parts[0].drop("__row")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    places = F.array_distinct(F.flatten(F.collect_list(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["until"] - 1))))))
    merged = whole.groupBy("__row", id_col, "n_words").agg(places.alias("places"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    firsts = F.array_sort(F.filter("places", lambda p: ~F.array_contains("places", p - 1)))
    lasts = F.array_sort(F.filter("places", lambda p: ~F.array_contains("places", p + 1)))
    spans = F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("until")))
    return merged.select(id_col, "n_words", F.size("places").cast("long").alias("n_hit"), "items", spans.alias("spans"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, action: str = "drop", text_col: str = "text", item_col: str = "item_id",
                  bench_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a window
    (``drop``), or with the hit words cut out of their texts (``cut``: from the
    first byte of a run of hit words to the last).  Blocks are applied one after
    the other."""
    if action not in ("drop", "cut"):
        raise ValueError(action)
    at, out = docs.columns.index(text_col), docs
    for items in _blocks(benchmark, item_col, bench_text_col, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Windows(items, n))

        def clean(batches, sent=sent):
            windows = sent.value
            for batch in batches:
                data, offsets = W.utf8(batch.column(at))
                keep, texts = np.ones(len(offsets) - 1, dtype=bool), {}
                for i, j in W.slices(offsets):
                    part = data[offsets[i] : offsets[j]]
                    start, end, row, hit, _ = windows.scan(part, offsets[i : j + 1] - offsets[i])
                    for r, _, _, a, b in _spans(start, end, row, hit):
                        keep[i + r] = False
                        texts.setdefault(i + r, []).append((a + int(offsets[i]), b + int(offsets[i])))
                if action == "drop":
                    yield batch.filter(pa.array(keep))
                elif not texts:
                    yield batch
                else:
                    column = batch.column(at).to_pylist()
                    for r, cuts in texts.items():
                        ends = [int(offsets[r]), *(b for _, b in cuts)]
                        begins = [*(a for a, _ in cuts), int(offsets[r + 1])]
                        column[r] = b"".join(data[x:y].tobytes() for x, y in zip(ends, begins)).decode()
                    yield batch.set_column(at, batch.schema.field(at), pa.array(column, batch.schema.field(at).type))

        out = out.mapInArrow(clean, docs.schema)
    return out
