"""Token ids in training order, as fixed-stride binary shards.

Documents are tokenised once and written; each text's ids end with an end mark,
and all of them form one stream, in the order of the written table.  The stream
is cut into sequences of ``length`` ids; the last one is filled with end marks.
A keyed Feistel network on the next even number of bits, walked until it lands
below the number of sequences, permutes the sequence numbers: slot i of the
training order holds sequence s with permute(s) = i.  A shard is a range of
slots, written by one task as raw little-endian ids, so that slot i is found at a
fixed offset and reading can resume anywhere.

Stream offsets are a prefix sum over partitions (one row each, broadcast) plus
a running sum inside a partition; token ids are shuffled once, to the task that
writes their shard.  Between the steps ids are held as zstd-compressed bytes, in the written
table blocks of texts together.  A task holds one shard's bytes.  A shard is written under a
name of its attempt and then renamed, so a lost executor leaves no half file.

Defined results: null and empty texts are an end mark alone; repeated rows are
tokenised each; an empty table gives no shard.
"""

from __future__ import annotations

import base64
import hashlib
import importlib.util
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import written
from cohortkit.runtime import scratch_path

__all__ = ["permute", "invert", "write_shards", "read_slot"]

_ROUNDS = 4
_encoders: dict[str, object] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _feistel(x: np.ndarray, n: int, key: int, back: bool) -> np.ndarray:
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    x = x.astype(np.uint64)
    todo = np.ones(len(x), dtype=bool)
    while todo.any():
        left, right = x[todo] >> bits, x[todo] & mask
        for r in range(_ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + (_ROUNDS - 1 - r if back else r) + 1) & 0xFFFFFFFFFFFFFFFF)
            if back:
                left, right = right ^ (_mix(left + salt) & mask), left
            else:
                left, right = right, left ^ (_mix(right + salt) & mask)
        x[todo] = (left << bits) | right
        todo = x >= n  # walk on: the network permutes a larger set
    return x.astype(np.int64)


def permute(sequence: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of sequences, a permutation of 0 .. n - 1."""
    return _feistel(sequence, n, key, False)


def invert(slot: np.ndarray, n: int, key: int) -> np.ndarray:
    """Sequences of slots."""
    return _feistel(slot, n, key, True)


def encoder(vocabulary: str):
    """A tiktoken encoder over a ``.tiktoken`` file, with the byte-pair
    pattern of the package beside it."""
    if vocabulary not in _encoders:
        import tiktoken

        spec = importlib.util.spec_from_file_location("public_tokenizers_pattern", os.path.join(os.path.dirname(vocabulary), "__init__.py"))
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[vocabulary] = tiktoken.Encoding("own", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


#: Ids (bytes, before compression) of texts that are compressed together.
_BLOCK = 4 << 20
_LEVEL = 9


def _packed(ids: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=_LEVEL).compress(ids, asbytes=True)


def _unpacked(ids: pa.Scalar, size: int) -> pa.Buffer:
    return pa.decompress(ids.as_buffer(), decompressed_size=2 * int(size), codec="zstd")


def tokenised(docs: DataFrame, vocabulary: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each block of texts that follow each other: ``id`` and ``sizes``
    (with the end marks) of its texts, ``part`` and ``start`` (place in its partition's stream), ``ids``
    (uint16 as compressed bytes) with the end marks, ``size`` of them."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    kind = source.schema["id"].dataType.simpleString()

    def encode(batches):
        enc, at = encoder(vocabulary), 0
        mark = np.array([end], "<u2").tobytes()

        def block(batch, first, texts):
            size = sum(map(len, texts)) // 2
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column(0).slice(first, len(texts))), batch.column(2).slice(first, 1), pa.array([at], pa.int64()),
                pa.array([[len(x) // 2 for x in texts]], pa.list_(pa.int64())), pa.array([size], pa.int64()), pa.array([_packed(b"".join(texts))], pa.binary())], ["id", "part", "start", "sizes", "size", "ids"]), size

        for batch in batches:
            first, texts, held = 0, [], 0
            for i in range(batch.num_rows):
                texts.append(np.asarray(enc.encode_ordinary(batch.column(1)[i].as_py() or ""), "<u2").tobytes() + mark)
                held += len(texts[-1])
                if held >= _BLOCK or i + 1 == batch.num_rows:
                    out, size = block(batch, first, texts)
                    yield out
                    at, first, texts, held = at + size, i + 1, [], 0

    return source.mapInArrow(encode, f"id array<{kind}>, part int, start long, sizes array<long>, size long, ids binary")


def write_shards(docs: DataFrame, vocabulary: str, end: int = 50256, length: int = 1024, shard_slots: int = 4096, key: int = 17,
                 folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards and return one row for each slot: ``slot``,
    ``sequence``, ``shard``, ``offset`` (bytes), ``n_tokens`` (before filling),
    ``doc_ids`` (in order), ``sha256`` of its bytes, and the ``file``."""
    folder = folder or scratch_path(docs.sparkSession, "shards")
    tokens = written(tokenised(docs, vocabulary, end, id_col, text_col), "tokens")
    parts = tokens.groupBy("part").agg(F.sum("size").alias("size"))  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.select("part", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "stream")
    total = parts.agg(F.sum("size")).first()[0] or 0
    n = -(-total // length)
    kind = tokens.schema["id"].dataType.elementType.simpleString()
    placed = tokens.join(F.broadcast(parts.select("part", "base")), "part").select("id", (F.col("base") + F.col("start")).alias("start"), "ids", "sizes", "size")

    def pieces(batches):
        for batch in batches:
            for block in range(batch.num_rows):  # one block's ids at a time
                origin = batch.column(1)[block].as_py()
                size = batch.column(3)[block].values.to_numpy()
                start = origin + np.cumsum(size) - size
                first, last = start // length, (start + size - 1) // length
                count = last - first + 1
                row = np.repeat(np.arange(len(start)), count)
                sequence = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
                a = np.maximum(sequence * length, start[row])
                b = np.minimum((sequence + 1) * length, (start + size)[row])
                data = _unpacked(batch.column(2)[block], batch.column(4)[block].as_py())
                slot = permute(sequence, n, key)
                # the block's pieces of a shard are compressed together
                order = np.argsort(slot // shard_slots, kind="stable")
                shard = (slot // shard_slots)[order]
                edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
                cut = [_packed(b"".join(data.slice(2 * int(a[i] - origin), 2 * int(b[i] - a[i])) for i in order[x:y])) for x, y in zip(edges[:-1], edges[1:])]
                lists = pa.array(edges, pa.int32())
                columns = [batch.column(0)[block].values.take(pa.array(row[order])), *[pa.array(x[order]) for x in (sequence, slot, a - sequence * length, b - a)]]
                yield pa.RecordBatch.from_arrays([pa.array(shard[edges[:-1]]), *[pa.ListArray.from_arrays(lists, x) for x in columns], pa.array(cut, pa.binary())], ["shard", "id", "sequence", "slot", "at", "size", "ids"])

    cut = placed.mapInArrow(pieces, f"shard long, id array<{kind}>, sequence array<long>, slot array<long>, at array<long>, size array<long>, ids binary")
    cut = cut.repartition(max(1, -(-n // shard_slots)), "shard").sortWithinPartitions("shard")

    def write(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        held: dict = {}

        def finish():
            shard, rows, data = held["shard"], held["rows"], held["data"]
            slots = sorted(rows)
            final, own = f"{root}/shard-{shard:08d}.bin", f"{root}/.shard-{shard:08d}-{uuid.uuid4().hex}"
            store.create_dir(root, recursive=True)
            with store.open_output_stream(own) as f:
                f.write(data[: len(slots)].tobytes())
            store.move(own, final)
            yield pa.RecordBatch.from_pydict({
                "slot": pa.array(slots, pa.int64()), "sequence": pa.array([rows[s][0] for s in slots], pa.int64()), "shard": pa.array([shard] * len(slots), pa.int64()),
                "offset": pa.array([(s - shard * shard_slots) * length * 2 for s in slots], pa.int64()), "n_tokens": pa.array([rows[s][1] for s in slots], pa.int64()),
                "doc_ids": pa.array([[i for _, i in sorted(rows[s][2], key=lambda x: x[0])] for s in slots], pa.list_(held["kind"])), "sha256": [hashlib.sha256(data[s - shard * shard_slots].tobytes()).hexdigest() for s in slots],
                "file": [final] * len(slots)})

        for batch in batches:
            for i, shard in enumerate(batch.column(0).to_pylist()):
                if held.get("shard") != shard:
                    if held:
                        yield from finish()
                    held = {"shard": shard, "rows": {}, "data": np.full((shard_slots, length), end, "<u2"), "kind": batch.schema.field(1).type.value_type}
                sizes = batch.column(5)[i].values.to_numpy()
                ids, first = np.frombuffer(_unpacked(batch.column(6)[i], sizes.sum()), "<u2"), 0
                for own, sequence, slot, at, size in zip(*[batch.column(c)[i].values.to_pylist() for c in (1, 2, 3, 4, 5)]):
                    held["data"][slot - shard * shard_slots, at : at + size] = ids[first : first + size]
                    first += size
                    row = held["rows"].setdefault(slot, [sequence, 0, []])
                    row[1] += size
                    row[2].append((at, own))
        if held:
            yield from finish()

    return written(cut.mapInArrow(write, f"slot long, sequence long, shard long, offset long, n_tokens long, doc_ids array<{kind}>, sha256 string, file string"), "slots")


def read_slot(file: str, offset: int, length: int = 1024) -> np.ndarray:
    """The ids of one slot, by its file and offset."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(file) if ":" in file else (fs.LocalFileSystem(), file)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_at(2 * length, offset), "<u2")
