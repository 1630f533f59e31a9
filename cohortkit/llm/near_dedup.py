"""Near-duplicate documents by DartMinHash signatures.

A document is the weighted set of its shingles of ``n`` words (lower-cased
letters, digits, non-ASCII; weight: occurrences).  Texts of fewer words, but
not none, are one shingle.  Likeness is weighted Jaccard: sum of the lesser
weights over sum of the greater.

Darts: every unit of weight (a shingle and the number of its occurrence) is hit
by a Poisson process of darts in rank, drawn from a hash of that unit alone, so
equal units are hit alike in every document.  A document looks at the darts of
rank below ``t`` over its total weight - about ``t`` darts at any length - and
each dart falls on one of ``k`` coordinates; a coordinate keeps its earliest
dart.  Documents with a coordinate that no dart hit look on to twice the rank.
Two documents agree on a coordinate with a probability equal to their likeness.

Bands of ``rows`` coordinates are joined; with 40 bands of 6, a pair at 0.8
shares no band with probability 5e-6.  Exact copies (equal word sequences) are
one class first, and only class representatives go on.  No bucket is expanded
into all pairs:

1. every document of a bucket is paired with a central one (linear);
2. verified links give components, and documents outside the largest component
   of a bucket are paired with the two most alike of other components;
3. what still shares a bucket without sharing a component is compared in full
   inside the task: by signatures first (low bytes, which agree at least as
   often), and where those agree on 0.8 less four standard errors or more, by
   the sets, which are sent for such documents only.  Only links are given out.

So any two documents of a bucket end in one group, or were compared.  Every
link is verified on the whole shingle sets.

Bounds: buckets are cut into blocks of about 4 096 rows (step 3: all pairs of
blocks); signatures are of fixed size; shingle sets travel only for documents in
pairs; nothing is collected.  ``classes`` and ``keep_one`` number the rows of a
written copy of their input, and that number is the node: ids may be null or
repeated.  Defined results: null texts and texts without a word are alone in
their class; a class is named by its least id that isn't null; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import words as W
from cohortkit.llm.common import packed, written
from cohortkit.llm.graph import components, mixed_buckets

__all__ = ["signatures", "links", "classes", "keep_one", "shingle_units", "darts"]

#: Salts over which the rows of a group are dealt when the group is named.
_SALTS = 32

_TO_UNIT = 1.0 / float(1 << 53)


def shingle_units(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every unit of weight, and each row's word count and
    hash of its word sequence."""
    start, end, row = W.find_words(data, offsets, W.ALNUM)
    n_rows = len(offsets) - 1
    h = W.hash_words(data, start, end)
    first = np.searchsorted(row, np.arange(n_rows + 1))
    n_words = np.diff(first)
    whole = W.hash_ngrams(h, n)
    inside = row[: len(whole)] == row[n - 1 :] if len(whole) else np.zeros(0, bool)
    rows, units = [row[: len(whole)][inside]], [whole[inside]]
    for size in range(1, n):  # short texts: one shingle
        short = np.flatnonzero(n_words == size)
        if len(short):
            rows.append(short)
            units.append(W.hash_ngrams(h, size)[first[short]])
    row, unit = np.concatenate(rows), np.concatenate(units)
    # the j-th occurrence of a shingle is a unit of its own; few shingles occur twice in a row
    both = W.mix(unit + (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    sorted_both = np.sort(both)
    twice = W.distinct(sorted_both[1:][sorted_both[1:] == sorted_both[:-1]])
    if len(twice):
        at = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, both), len(twice) - 1)] == both)
        at = at[np.argsort(both[at], kind="stable")]
        new, place = np.r_[True, both[at][1:] != both[at][:-1]], np.arange(len(at))
        nth = place - np.maximum.accumulate(np.where(new, place, 0))
        unit[at] = np.where(nth > 0, W.mix(unit[at] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), unit[at])
    # hash of the word sequence: position by position, summed
    place = (np.arange(len(h)) - first[np.searchsorted(first, np.arange(len(h)), side="right") - 1]).astype(np.uint64) if len(h) else np.zeros(0, np.uint64)
    terms = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(W.mix(h + (place + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)), out=terms[1:])
    return row, unit, n_words, terms[first[1:]] - terms[first[:-1]]


def darts(row: np.ndarray, unit: np.ndarray, n_rows: int, k: int, t: float) -> np.ndarray:
    """``n_rows`` x ``k`` signatures (uint32): the earliest dart by coordinate."""
    out = np.zeros((n_rows, k), np.uint32)
    weight = np.bincount(row, minlength=n_rows)
    left = weight > 0
    theta = np.where(left, t / np.maximum(weight, 1), 0.0)
    while left.any():
        rank = np.full(n_rows * k, np.inf)
        mark = np.zeros(n_rows * k, np.uint32)
        live = left[row]
        r, u, state, at = row[live], unit[live], unit[live], np.zeros(int(live.sum()))
        found = []
        while len(r):
            state = W.mix(state + np.uint64(0x9E3779B97F4A7C15))
            at = at - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * _TO_UNIT)
            on = at < theta[r]
            r, u, state, at = r[on], u[on], state[on], at[on]
            dart = W.mix(state ^ np.uint64(0xA0761D6478BD642F))
            found.append((r * k + (dart >> np.uint64(32)).astype(np.int64) % k, at, (dart & np.uint64(0xFFFFFFFF)).astype(np.uint32)))
        cell = np.concatenate([f[0] for f in found])
        when = np.concatenate([f[1] for f in found])
        what = np.concatenate([f[2] for f in found])
        np.minimum.at(rank, cell, when)
        best = when == rank[cell]
        mark[cell[best]] = what[best]
        hit = np.isfinite(rank).reshape(n_rows, k)
        full = left & hit.all(axis=1)
        out[full] = mark.reshape(n_rows, k)[full]
        left = left & ~full
        theta = theta * 2
    return out


def signatures(docs: DataFrame, n: int = 5, k: int = 240, id_col: str = "doc_id", text_col: str = "text", bands: int | None = None) -> DataFrame:
    """One row for each document with a word and an id: ``node`` (its id),
    ``n_words``, ``same`` (hash of its words in order) and ``signature`` (k
    numbers as bytes).  With ``bands``, in its place ``bands`` (a hash of each
    band) and ``brief`` (the low byte of each number)."""
    t = k * (np.log(k) + 3.0)
    names = ["signature"] if bands is None else ["bands", "brief"]
    source = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text")).where("node is not null and text is not null")

    def sign(batches):
        for batch in batches:
            data, offsets = W.utf8(batch.column(1))
            # a text has about t darts at any length: many short ones are cut by rows
            for i, j in W.slices(offsets, 1 << 18, 256):
                row, unit, n_words, same = shingle_units(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                marks = darts(row, unit, j - i, k, t)
                keep = pa.array(n_words > 0)
                out = [marks] if bands is None else [_band_hashes(marks, bands), (marks & 0xFF).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n_words), pa.array(same.view(np.int64)),
                                                  *[pa.array([m.tobytes() for m in x], pa.binary()) for x in out]], ["node", "n_words", "same", *names]).filter(keep)

    kind = source.schema["node"].dataType.simpleString()
    return source.mapInArrow(sign, f"node {kind}, n_words long, same long, " + ", ".join(f"{name} binary" for name in names))


def _shingle_sets(docs: DataFrame, nodes: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Sorted units (as bytes) of the documents in ``nodes``."""
    source = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text")).join(nodes, "node", "left_semi")

    def units(batches):
        for batch in batches:
            data, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets):
                row, unit, _, _ = shingle_units(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                order = np.lexsort((unit, row))
                row, unit = row[order], unit[order]
                first = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([unit[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())], ["node", "units"])

    kind = source.schema["node"].dataType.simpleString()
    return source.mapInArrow(units, f"node {kind}, units binary").dropDuplicates(["node"])


def _units(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), np.uint64)


def _likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Weighted Jaccard: units of weight in both over units in either."""
    both = np.sort(np.concatenate([x, y]))
    both = int((both[1:] == both[:-1]).sum())
    return both / (len(x) + len(y) - both)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose likeness reaches the threshold: (a, b, likeness)."""
    wide = pairs.join(sets.select(F.col("node").alias("a"), F.col("units").alias("left")), "a").join(sets.select(F.col("node").alias("b"), F.col("units").alias("right")), "b")
    kind = pairs.schema["a"].dataType.simpleString()

    def compare(batches):
        for batch in batches:
            alike = np.empty(batch.num_rows)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                alike[i] = _likeness(_units(x), _units(y))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike)], ["a", "b", "likeness"])
            yield out.filter(pa.array(alike >= threshold))

    return wide.select("a", "b", "left", "right").mapInArrow(compare, f"a {kind}, b {kind}, likeness double")


def links(docs: DataFrame, n: int = 5, threshold: float = 0.8, rows: int = 6, bands: int = 40, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Verified links between class representatives (a, b, likeness), and the
    membership (``node``, ``rep``: least id with the same words)."""
    signed = signatures(docs, n, rows * bands, id_col, text_col, bands).withColumn("row", F.monotonically_increasing_id())
    signed = written(signed, "signatures")
    least = signed.groupBy("same", "n_words").agg(F.min(F.struct("node", "row")).alias("least"), F.count(F.lit(1)).alias("count"))
    least = written(least.select("same", "n_words", F.col("least.node").alias("rep"), F.col("least.row").alias("row"), "count"), "least")
    crowd = least.where("count > 1").select("same", "n_words", "rep")
    member = written(signed.select("node", "same", "n_words").join(crowd, ["same", "n_words"]).select("node", "rep").distinct(), "copies")
    chosen = least.groupBy("rep").agg(F.min("row").alias("row")).select("row")
    reps = written(signed.join(chosen, "row", "left_semi").select("node", "bands", "brief"), "reps")

    def cut(batches):
        for batch in batches:
            band = np.frombuffer(b"".join(x.as_py() for x in batch.column(1)), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), bands))), pa.array(band)], ["node", "bucket"])

    kind = signed.schema["node"].dataType.simpleString()
    # one shuffle by bucket: the count and the join read the same exchange, with the same columns
    buckets = reps.select("node", "bands").mapInArrow(cut, f"node {kind}, bucket long").repartition("bucket")
    shared = buckets.groupBy("bucket").agg(F.count("node").alias("size")).where("size > 1")
    buckets = written(buckets.join(shared, "bucket"), "shared-buckets")
    cutoff = threshold - 4 * (threshold * (1 - threshold) / (rows * bands)) ** 0.5
    first = _bucket_pairs(buckets.withColumns({"root": F.col("node"), "minor": F.lit(False)}), reps, "hub", cutoff)
    found = _checked(docs, first.select("a", "b"), n, threshold, id_col, text_col, "hub")
    for how in ("best", "rest"):
        root = components(found)
        rooted = buckets.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = written(mixed_buckets(rooted, ["bucket"], "root").withColumn("minor", F.col("root") != F.col("main")), f"mixed-{how}")
        if how == "best":
            more = _checked(docs, _bucket_pairs(mixed, reps, how, cutoff).select("a", "b"), n, threshold, id_col, text_col, how)
        else:
            # only documents with an open partner that is alike by signature need their sets sent
            some = written(_bucket_pairs(mixed, reps, "seek", cutoff).select(F.col("p").alias("node")).distinct(), "open")
            mixed = mixed.join(some, "node", "left_semi")
            sets = _shingle_sets(docs, some, n, id_col, text_col)
            more = written(_bucket_pairs(mixed, reps.join(sets, "node"), how, cutoff, threshold).distinct(), "rest-links")
        found = found.unionByName(more)
    return found, member


def _band_hashes(marks: np.ndarray, bands: int) -> np.ndarray:
    """One number by document and band; equal only for the same band."""
    marks = marks.reshape(len(marks), bands, -1).astype(np.uint64)
    acc = np.zeros(marks.shape[:2], np.uint64)
    for i in range(marks.shape[2]):
        acc = W.mix(acc * np.uint64(0x9E3779B97F4A7C15) + marks[:, :, i] + np.uint64(1))
    return W.mix(acc + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).view(np.int64)


#: Rows of a bucket that are compared as one block.
_BLOCK = 4096


def _bucket_pairs(rows: DataFrame, reps: DataFrame, how: str, cutoff: float, threshold: float | None = None) -> DataFrame:
    """Pairs (a < b) of ``rows`` (bucket, size, node, root, minor) by one of the
    three steps; with a threshold, those whose likeness reaches it.  ``role``: 0 plays both sides, 1 the minor, 2 the other one."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / _BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    if how in ("seek", "rest"):
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        as_minor = F.when(F.col("minor"), F.transform(every, lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(1).alias("role")))).otherwise(F.array())
        as_other = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(2).alias("role")))
        both = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("role")))
        rows = rows.withColumn("at", F.explode(F.when(F.col("blocks") == 1, both).otherwise(F.concat(as_minor, as_other))))
    else:
        rows = rows.withColumn("at", F.struct(F.col("own").alias("i"), F.lit(0).alias("j"), F.lit(0).alias("role")))
    kind = rows.schema["node"].dataType.simpleString()
    rows = rows.select("bucket", "at.i", "at.j", "at.role", "node", "root", "minor").join(reps if threshold else reps.select("node", "brief"), "node")
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    rows = rows.select("node", "root", "minor", "role", "bucket", F.xxhash64("bucket", "i", "j").alias("run"), "brief", *(["units", "bands"] if threshold else []))

    def pair(batches):
        for batch in _whole_runs(batches):
            run = batch.column(5).to_numpy()
            marks = np.frombuffer(b"".join(x.as_py() for x in batch.column(6)), np.uint8).reshape(batch.num_rows, -1)
            band = np.frombuffer(b"".join(x.as_py() for x in batch.column(8)), np.int64).reshape(batch.num_rows, -1) if threshold else None
            root, bucket = batch.column(1).dictionary_encode().indices.to_numpy(), batch.column(4).to_numpy()
            minor, role = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
            edges = np.r_[0, np.flatnonzero(run[1:] != run[:-1]) + 1, len(run)]
            left, right, alike = [], [], []
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                for p, q in _run_pairs(how, marks[x:y], root[x:y], minor[x:y], role[x:y], int(bucket[x]), None if band is None else band[x:y], cutoff):
                    likeness = np.full(len(q), np.nan)
                    if threshold:
                        mine = _units(batch.column(7)[x + p])
                        likeness = np.array([_likeness(mine, _units(batch.column(7)[x + int(o)])) for o in q])
                        q, likeness = q[likeness >= threshold], likeness[likeness >= threshold]
                    left.append(np.full(len(q), x + p))
                    right.append(x + q)
                    alike.append(likeness)
            if left:
                left, right = pa.array(np.concatenate(left)), pa.array(np.concatenate(right))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(left), batch.column(0).take(right), pa.array(np.concatenate(alike))], ["p", "q", "likeness"])

    pairs = rows.mapInArrow(pair, f"p {kind}, q {kind}, likeness double")
    return pairs if how == "seek" else pairs.where("p != q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "likeness")


def _whole_runs(batches):
    """Batches whose runs (column 5) are whole."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        run = batch.column(5).to_numpy()
        last = int(np.flatnonzero(np.r_[True, run[1:] != run[:-1]])[-1])
        if last:
            yield batch.slice(0, last)
        held = batch.slice(last)
    if held is not None:
        yield held


def _run_pairs(how: str, marks: np.ndarray, root: np.ndarray, minor: np.ndarray, role: np.ndarray, bucket: int, band: np.ndarray | None, cutoff: float):
    """(position, positions it is paired with) in one block."""
    n = len(marks)
    if how == "hub":
        some = np.arange(n) if n <= 16 else np.linspace(0, n - 1, 16).astype(int)
        agree = np.zeros(n)
        for m in some:
            agree += (marks == marks[m]).mean(axis=1)
        hub = int(agree.argmax())
        alike = (marks == marks[hub]).mean(axis=1) >= cutoff
        alike[hub] = False
        if alike.any():
            yield hub, np.flatnonzero(alike)
        return
    seen = np.zeros(n, dtype=bool)
    for p in np.flatnonzero(minor & (role != 2)):
        other = np.flatnonzero((root != root[p]) & (role != 1))
        if how == "rest":  # a pair counts in the first band it shares, and once if both are minor
            other = other[~minor[other] | (other > p) | (role[other] != 0)]
            same = band[other] == band[p]
            other = other[(same.any(axis=1)) & (band[p][same.argmax(axis=1)] == bucket)]
        alike = (marks[other] == marks[p]).mean(axis=1)
        on = alike >= cutoff
        other, alike = other[on], alike[on]
        if how == "best" and len(other) > 2:
            other = other[np.argsort(-alike, kind="stable")[:2]]
        if how == "seek":
            seen[other] = True
            seen[p] |= len(other) > 0
        elif len(other):
            yield int(p), other
    for p in np.flatnonzero(seen):
        yield int(p), np.array([p])


def _checked(docs: DataFrame, pairs: DataFrame, n: int, threshold: float, id_col: str, text_col: str, name: str) -> DataFrame:
    """The pairs that reach the threshold on their whole shingle sets."""
    pairs = written(pairs.distinct(), f"{name}-candidates")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = written(_shingle_sets(docs, nodes, n, id_col, text_col), f"{name}-sets")
    return written(_verified(pairs, sets, threshold), f"{name}-links")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written with a number of each row, which holds from then on."""
    return written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def _roots(rows: DataFrame, n: int, threshold: float, text_col: str, **how) -> DataFrame:
    """Rows in a group (``__row``), with the least row of the group (``root``)."""
    found, member = links(rows, n, threshold, id_col="__row", text_col=text_col, **how)
    ties = found.select("a", "b").unionByName(member.where("node != rep").select(F.col("rep").alias("a"), F.col("node").alias("b")))
    return written(components(ties).withColumnRenamed("node", "__row"), "roots")


def classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each row of ``docs``: its id and ``class_id``, the least id of
    its group (its own if it stands alone)."""
    rows = _numbered(docs.select(id_col, text_col))
    root, ids = _roots(rows, n, threshold, text_col, **how), rows.select("__row", id_col)
    names = root.join(ids, "__row").groupBy("root").agg(F.min(id_col).alias("class_id"))
    # salted: one group may hold a large share of all rows
    names = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    named = root.withColumn("salt", F.pmod(F.xxhash64("__row"), F.lit(_SALTS)).cast("int")).join(names, ["root", "salt"]).select("__row", "class_id")
    return ids.join(named, "__row", "left").select(id_col, F.coalesce("class_id", id_col).alias("class_id"))


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with all columns, one row of each group: the one with the least
    id, of equal ids the first row; null ids come last.  Rows without a group or
    a word all stay; rows that repeat an id with other words are judged by their
    own words."""
    rows = packed(docs, "numbered")
    own = rows.select(F.col("row").alias("__row"), F.col("doc")[id_col].alias("id"), F.col("doc")[text_col].alias("text"))
    root = _roots(own.select("__row", "text"), n, threshold, "text", **how)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("__row").alias("row"))
    first = root.join(own.select("__row", "id"), "__row").groupBy("root").agg(F.min(order).alias("first"))
    gone = root.join(first.select(F.col("first.row").alias("__row")), "__row", "left_anti").select(F.col("__row").alias("row"))
    return rows.join(gone, "row", "left_anti").select("doc.*")
