"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted in one scan: one of the
target (documents labelled good) and one of the raw text (all documents).  A
document's importance weight is the product of the ratios target / raw over
its distinct n-grams; Gumbel noise is added to the log weight, and the
``k`` documents with the largest sums are kept (sampling without replacement in
proportion to the weights).  The rest is rejected.

N-grams: words and word pairs (lower-cased letters, digits and non-ASCII),
shapes of blank-separated tokens and pairs of shapes (case, closing symbols,
a token that repeats the one before it).  Counts are numbers of documents, so
one document that repeats itself counts once.

Ratio of an n-gram: (target + a) / (raw * share + a), divided by the median
ratio of its kind - the raw text holds the rejects too, which lifts every usual
n-gram by the same factor and would make weights grow with length.  Log ratios
within ``dead`` plus 1.5 / sqrt(expected + 1) of that median count as 0: sampling
error, not evidence.

Bounds: the model is a fixed number of buckets (about 680 000) whatever the
input; labels are used up to ``max_labels`` documents, those with the smallest
hashes of their ids (the only sample here; counts of raw text and the scores
cover all documents).  ``k`` is the document count times the labelled share of
good documents, taken ``z`` standard errors up, so clean documents stay.

Defined results: null and empty texts have weight 1; documents equal in id and
text tie and stay or go together; a tie at the k-th place is kept whole; labels
that contradict each other make a document no target; null labels are left
out; without any target label all documents are kept.  Documents keep all their
columns.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm import words as W
from cohortkit.llm.common import unit_random, written

__all__ = ["fit", "log_weights", "resample", "kth_largest", "Ratios"]

#: Labelled documents used at most.
MAX_LABELS = 200_000

#: Bits of the bucket tables: words, word pairs, shapes, shape pairs.
_BITS = (19, 17, 12, 14)
_FIRST = np.cumsum([0] + [1 << b for b in _BITS])
_WIDTH = 20  # bits that hold any bucket


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (h >> np.uint64(64 - _BITS[kind])).astype(np.int64) + int(_FIRST[kind])


def _shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and shape hash of each blank-separated token."""
    start, end, row = W.find_words(data, offsets, W.NONSPACE)
    if not len(start):
        return row, np.zeros(0, np.uint64)
    upper, lower = np.r_[0, np.cumsum((data >= 65) & (data <= 90))], np.r_[0, np.cumsum((data >= 97) & (data <= 122))]
    h = W.hash_words(data, start, end, None)
    again = np.r_[False, (h[1:] == h[:-1]) & (row[1:] == row[:-1])]
    n_upper, n_lower = upper[end] - upper[start], lower[end] - lower[start]
    shape = np.minimum(n_upper, 2).astype(np.uint64) * np.uint64(8) + np.minimum(n_lower, 1).astype(np.uint64) * np.uint64(4)
    shape += (again * 2 + (np.minimum(end - start, 2) == 1)).astype(np.uint64)
    for back in (1, 2, 3):
        at = np.maximum(end - back, start)
        mark = data[at]
        shape = shape * np.uint64(256) + np.where(W.ALNUM[mark], 0, mark).astype(np.uint64)
    return row, W.mix(shape + np.uint64(1))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Distinct (row, bucket) pairs of a batch as numbers."""
    start, end, row = W.find_words(data, offsets, W.ALNUM)
    h = W.hash_words(data, start, end)
    shape_row, shape = _shapes(data, offsets)
    keys = []
    for kind, (r, x) in enumerate(((row, h), (row, h), (shape_row, shape), (shape_row, shape))):
        if kind % 2:
            same = r[1:] == r[:-1]
            r, x = r[1:][same], W.hash_ngrams(x, 2)[same] if len(x) > 1 else x[:0]
        keys.append((r << _WIDTH) | _bucket(x, kind))
    return np.concatenate([W.distinct(k) for k in keys])


class Ratios:
    """Centred log ratios by bucket."""

    def __init__(self, raw: np.ndarray, target: np.ndarray, n_raw: int, n_target: int, smooth: float, dead: float):
        self.log = np.zeros(int(_FIRST[-1]), np.float32)
        if not n_target:
            return
        expected = raw * (n_target / max(n_raw, 1))
        log = np.log((target + smooth) / (expected + smooth))
        for a, b in zip(_FIRST[:-1], _FIRST[1:]):
            order = np.argsort(log[a:b], kind="stable")
            mass = np.cumsum(raw[a:b][order])
            if mass[-1] == 0:
                continue
            middle = log[a:b][order[int(np.searchsorted(mass, mass[-1] / 2))]]
            x = log[a:b] - middle
            self.log[a:b] = np.sign(x) * np.maximum(np.abs(x) - dead - 1.5 / np.sqrt(expected[a:b] + 1), 0)


def _label_table(labels: DataFrame, id_col: str, target: Column, max_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Id hashes, sorted, and whether each is a target."""
    rows = (labels.where(target.isNotNull() & F.col(id_col).isNotNull()).groupBy(F.xxhash64(id_col).alias("id"))
            .agg(F.min(target.cast("int")).alias("good")).orderBy("id").limit(max_labels)).toArrow()
    return rows["id"].to_numpy(), rows["good"].to_numpy().astype(bool)


def fit(docs: DataFrame, labels: DataFrame, target: Column | str, id_col: str = "doc_id", text_col: str = "text", max_labels: int = MAX_LABELS,
        smooth: float = 1.0, dead: float = 0.4) -> tuple[Ratios, float, int]:
    """The ratios, the labelled share of targets, and the number of labels.
    ``target``: condition on the columns of ``labels``."""
    ids, good = _label_table(labels, id_col, F.expr(target) if isinstance(target, str) else target, max_labels)
    sent = docs.sparkSession.sparkContext.broadcast(ids[good])
    n_buckets = int(_FIRST[-1])

    def count(batches):
        raw, wanted = np.zeros(n_buckets + 1, np.int64), np.zeros(n_buckets + 1, np.int64)
        targets = sent.value
        for batch in batches:
            data, offsets = W.utf8(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            is_target = np.isin(ids, targets)
            for i, j in W.slices(offsets):
                keys = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                bucket = keys & ((1 << _WIDTH) - 1)
                raw[:-1] += np.bincount(bucket, minlength=n_buckets)
                wanted[:-1] += np.bincount(bucket[is_target[i:j][keys >> _WIDTH]], minlength=n_buckets)
                raw[-1] += j - i  # the last place counts documents
                wanted[-1] += int(is_target[i:j].sum())
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(wanted[at])], ["bucket", "raw", "wanted"])

    counts = (docs.select(F.xxhash64(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .mapInArrow(count, "bucket int, raw long, wanted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("wanted").alias("wanted"))
              .toArrow())  # at most one row for each bucket
    raw, wanted = np.zeros(n_buckets + 1), np.zeros(n_buckets + 1)
    at = counts["bucket"].to_numpy()
    raw[at], wanted[at] = counts["raw"].to_numpy(), counts["wanted"].to_numpy()
    del counts, at
    ratios = Ratios(raw[:-1], wanted[:-1], int(raw[-1]), int(wanted[-1]), smooth, dead)
    return ratios, float(good.mean()) if len(good) else 1.0, len(good)


def log_weights(docs: DataFrame, ratios: Ratios, text_col: str = "text", out: str = "log_weight") -> DataFrame:
    """``docs`` with the log importance weight as a last column ``out``."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios.log)
    at = docs.columns.index(text_col)

    def score(batches):
        log = sent.value
        for batch in batches:
            data, offsets = W.utf8(batch.column(at))
            weight = np.zeros(len(offsets) - 1)
            for i, j in W.slices(offsets):
                keys = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                weight[i:j] = np.bincount(keys >> _WIDTH, weights=log[keys & ((1 << _WIDTH) - 1)], minlength=j - i)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weight)], [*batch.schema.names, out])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of ``column`` (finite numbers), exactly, by
    narrowing histograms: each pass returns 1 024 counts."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        step = (high - low) / 1024
        bins = F.least(F.lit(1023), F.floor((F.col(column) - low) / step)) if step > 0 else F.lit(0)
        rows = (df.where(F.col(column).between(low, high)).groupBy(bins.cast("int").alias("bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("bin")).collect())
        for r in rows:
            if above + r.n >= k:
                break
            above += r.n
        if (r.low, r.high) == (low, high):  # no finer step: two neighbouring numbers
            return high if df.where(F.col(column) >= high).count() >= k else low
        low, high = r.low, r.high
    return low


def resample(docs: DataFrame, labels: DataFrame, target: Column | str, id_col: str = "doc_id", text_col: str = "text", keep: int | None = None,
             z: float = 2.0, seed: int = 17, max_labels: int = MAX_LABELS, columns: list[str] | None = None) -> DataFrame:
    """The kept documents: ``columns`` of ``docs`` (default: all) and a last
    column ``log_weight`` (unless one of them has that name).  ``keep``: how
    many (default: see above).  Scores are written once, with the columns asked
    for if the text isn't one of them; else the kept rows are filtered in
    another scan, so no text is shuffled."""
    columns = list(docs.columns) if columns is None else columns
    ratios, share, n_labels = fit(docs, labels, target, id_col, text_col, max_labels)
    noise = -F.log(-F.log(unit_random(F.col(id_col), seed)))
    narrow = text_col not in columns
    source = docs.select(*dict.fromkeys([id_col, text_col, *columns]))
    scored = log_weights(source, ratios, text_col, "__weight").withColumn("__score", F.col("__weight") + noise)
    scores = written(scored.select("__score", "__weight", *columns) if narrow else scored.select("__score"), "gumbel")
    n = scores.count()
    if keep is None:
        up = z * math.sqrt(share * (1 - share) / n_labels) if n_labels else 1.0
        keep = math.ceil(n * min(1.0, share + up))
    kept = scores if narrow else scored
    if keep < n:
        kept = kept.where(F.col("__score") >= F.lit(kth_largest(scores, "__score", keep))) if keep else kept.limit(0)
    weight = [] if "log_weight" in columns else [F.col("__weight").alias("log_weight")]
    return kept.select(*columns, *weight)
