"""Alignment of two tokenizers: which tokens of A overlap which tokens of B,
counted over the corpus with inverted pair bitmaps.

A text, with a space before it, is encoded by both tokenizers.  Byte offsets
where tokens of both end cut the two token rows into groups; a link is an
occurrence of an A token and one of a B token whose byte ranges overlap.  The
links of a text are the pieces between consecutive ends of either tokenizer,
since two overlapping tokens share exactly one such piece.

Postings.  Documents are dealt to blocks of consecutive slots, a block being
what one task gathers until it holds ``BLOCK_ENTRIES`` (pair, document)
entries.  For every pair and block there is one row: a container of the slots
whose document holds the pair (16-bit numbers, or a bit for every slot where
that is shorter), and planes: plane k has, for the r-th document of the
container, bit k of the number of links it has of this pair.  A pair's bitmap
is the OR of its containers, which lie in different blocks, so its popcount, the
number of documents, is the sum of the containers' popcounts, and its links are
the planes' popcounts times 2^k.  The pair counts then go back to the postings
by one join on the pair, and the postings to their block, where each block's
bitmaps are read once and give every document its scores.

Tokenising.  Neither tokenizer joins text over a single space between two
characters that aren't blanks (``_check`` verifies it for the given
vocabularies), so texts are cut there and each distinct piece is encoded once a
task while it is held.  Pieces are told apart by a 64-bit hash of their bytes.

Scale: two shuffles of the postings (by pair, by block), each about as large as
the compressed bitmaps; a pair has one row a block, a block at most
``BLOCK_ENTRIES`` entries and those of one slice of text (or one text).

Defined results: null and empty texts, and texts whose joined A or B bytes
differ from space + text, have no tokens: zeros and an empty digest.  Repeated
rows are documents of their own.  Null ids are returned as they are.  An empty
table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import words as W
from cohortkit.llm.common import shipped, written

__all__ = ["postings", "pair_counts", "score", "align", "Codec", "BLOCK_ENTRIES"]

#: (pair, document) entries after which a block is closed; at most 65536 documents.
BLOCK_ENTRIES = 2_000_000

#: Bytes of distinct pieces that a task holds encoded before it starts anew.
HELD_BYTES = 6 << 20

#: Bytes of pieces that are encoded as one text.
JOINED = 1 << 12

#: Bytes of text that one vectorised step handles.
STEP = 2 << 20

#: A pair is the number a * SECOND + b.
SECOND = 1 << 20

_codecs: dict[tuple[str, str], Codec] = {}


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character: printable
    Latin-1 bytes as themselves, the others from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all parts, and where each begins (with the end)."""
    return np.frombuffer(b"".join(parts), np.uint8), np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start .. start + size - 1 of every row, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Codec:
    """The two tokenizers with the bytes of their tokens, and the pieces
    encoded so far."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        of = _byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_data, self.a_at = _flat(a_bytes)
        self.b_data, self.b_at = _flat(b_bytes)
        self.cuts = self._check(a_file, pieces)
        digits = [f"{i}".encode() for i in range(max(len(a_bytes), n))]
        self.width = max(map(len, digits)) + 1
        self.n_digits = np.array([len(d) for d in digits])
        self.digits = np.frombuffer(b"".join(d.ljust(self.width) for d in digits), np.uint8).reshape(-1, self.width)
        self.forget()

    def _check(self, a_file: str, pieces: list[str]) -> bool:
        """Whether cutting at single spaces is exact: A splits words before a
        blank by its byte-level pattern, and no piece of B goes on with a blank
        after another character."""
        with open(a_file, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer")
        return bool(plain) and not any("▁" in p.lstrip("▁") for p in pieces)

    def forget(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted, and the piece of each
        self.held = 0
        self.text: list[bytes] = []
        self.facts = np.zeros((0, 6), np.int64)  # of each piece: n_a, n_b, n_groups, whether its bytes agree, links, where its pairs begin
        self.pairs = np.zeros(0, np.int64)

    def _encode(self, texts: list[bytes]) -> list[list[np.ndarray]]:
        """Ids of every text by A and by B; each text begins with the space that
        B adds itself."""
        a = self.a.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        b = self.b.encode([t[1:].decode() for t in texts], num_threads=1)
        return [[np.array(e.ids, np.int64) for e in a], [np.array(x, np.int64) for x in b]]

    def _sized(self, ids: list[np.ndarray], kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the text of each, the bytes of each and where those begin."""
        at = (self.a_at, self.b_at)[kind]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        return flat, np.repeat(np.arange(len(ids)), [len(x) for x in ids]), at[flat + 1] - at[flat], at[flat]

    def _agree(self, texts: list[bytes], encoded: list[list[np.ndarray]]) -> np.ndarray:
        """Whether each text's tokens have the bytes of the text, by A and B."""
        data, at = _flat(texts)
        fine = np.ones(len(texts), bool)
        for kind, own in ((0, self.a_data), (1, self.b_data)):
            _, row, size, begin = self._sized(encoded[kind], kind)
            fine &= np.bincount(row, size, len(texts)) == np.diff(at)
            on = fine[row]
            got = own[_ragged(begin[on], size[on])]
            where = np.flatnonzero(fine)
            want = data[_ragged(at[where], np.diff(at)[where])]
            of = np.repeat(where, np.diff(at)[where])
            fine[of[got != want]] = False
        return fine

    def tokens(self, texts: list[bytes], whole: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """Ids, the text of each and the bytes of each, by A and by B, of the
        texts whose bytes agree; and which texts those are.  Texts that aren't
        ``whole`` were cut at both ends, so several are encoded as one; the ends
        of all of them are ends of tokens."""
        order = np.argsort(whole, kind="stable")
        size = np.array([len(t) for t in texts], np.int64)[order]
        joint = (np.cumsum(size) - size) // JOINED
        joint = np.where(whole[order], joint[-1] + 1 + np.arange(len(texts)), joint)
        first = np.flatnonzero(np.r_[True, joint[1:] != joint[:-1]])
        runs = [order[x:y].tolist() for x, y in zip(first, np.r_[first[1:], len(texts)])]
        joined = [b"".join([texts[i] for i in run]) for run in runs]
        encoded = self._encode(joined)
        good = self._agree(joined, encoded)
        again = [i for run, ok in zip(runs, good) if not ok and len(run) > 1 for i in run]
        single = self._encode([texts[i] for i in again]) if again else [[], []]
        kept = self._agree([texts[i] for i in again], single) if again else np.zeros(0, bool)
        runs = [run for run, ok in zip(runs, good) if ok] + [[i] for i, ok in zip(again, kept) if ok]
        member = np.array([i for run in runs for i in run], np.int64)
        fine = np.zeros(len(texts), bool)
        fine[member] = True
        ends = np.cumsum(np.array([len(texts[i]) for i in member], np.int64))
        back = np.argsort(member)
        out = []
        for kind in (0, 1):
            ids, _, width, _ = self._sized([x for x, ok in zip(encoded[kind], good) if ok] + [x for x, ok in zip(single[kind], kept) if ok], kind)
            edge = np.r_[0, np.searchsorted(np.cumsum(width), ends) + 1] if len(ends) else np.zeros(1, np.int64)
            n = np.diff(edge)
            place = _ragged(edge[:-1][back], n[back])  # in the order of the texts
            out.append((ids[place], np.repeat(member[back], n[back]), width[place]))
        return out, fine

    def learn(self, texts: list[bytes], whole: np.ndarray, keys: np.ndarray) -> None:
        """Encode pieces and hold what documents need of each."""
        ((a, a_row, a_size), (b, b_row, b_size)), fine = self.tokens(texts, whole)
        n_a, n_b = np.bincount(a_row, minlength=len(texts)), np.bincount(b_row, minlength=len(texts))
        size = np.array([len(t) for t in texts], np.int64) * fine
        total = int(size.sum())
        in_a, in_b = np.zeros(total + 1, np.int64), np.zeros(total + 1, np.int64)
        in_a[np.cumsum(a_size)] = 1  # a token ends before this byte
        in_b[np.cumsum(b_size)] = 1
        either = np.flatnonzero(in_a | in_b)
        ia, ib = np.cumsum(in_a)[either] - in_a[either], np.cumsum(in_b)[either] - in_b[either]
        pairs = a[ia] * SECOND + b[ib]
        edge = np.r_[0, np.cumsum(size)]
        link_at = np.searchsorted(either, edge, side="right")
        both = np.flatnonzero(in_a & in_b)
        group_at = np.searchsorted(both, edge, side="right")
        # groups as text: tokens in their order, a comma, bar or semicolon after each
        a_end, b_end = np.cumsum(in_a)[both], np.cumsum(in_b)[both]  # tokens of A, B up to each group's end
        a_group = np.repeat(np.arange(len(both)), np.diff(np.r_[0, a_end]))
        b_group = np.repeat(np.arange(len(both)), np.diff(np.r_[0, b_end]))
        place_a = np.arange(len(a)) + np.r_[0, b_end][a_group]
        place_b = np.arange(len(b)) + a_end[b_group]
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a[a_end - 1]], after[place_b[b_end - 1]] = ord("|"), ord(";")
        shown = self.digits[ids]
        shown[np.arange(len(ids)), self.n_digits[ids]] = after
        shown = shown[np.arange(self.width) <= self.n_digits[ids][:, None]].tobytes()
        text_at = np.r_[0, np.cumsum(self.n_digits[ids] + 1)][np.r_[0, np.cumsum(n_a + n_b)]]
        hashes, numbers = np.concatenate([self.hashes, keys]), np.concatenate([self.numbers, len(self.text) + np.arange(len(keys))])
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], numbers[order]
        self.text.extend(shown[x:y] for x, y in zip(text_at[:-1].tolist(), text_at[1:].tolist()))
        self.facts = np.concatenate([self.facts, np.column_stack([n_a, n_b, np.diff(group_at), fine, np.diff(link_at), link_at[:-1] + len(self.pairs)])])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.held += int(size.sum()) + len(texts)

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and row of the pieces of texts that begin with a space:
        cut before a single space between characters that are surely no blanks."""
        n = len(data)
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True
        if self.cuts and n > 2:
            x = np.flatnonzero(data == 0x20)
            x = x[(x >= 4) & (x < n - 1)]
            plain = _PLAIN[data]
            before = plain[x - 1] | (_TWO[data[x - 2]] & _TAIL[data[x - 1]]) | (_THREE[data[x - 3]] & _TAIL[data[x - 1]])
            x = x[before & (plain | _TWO[data] | _THREE[data])[x + 1]]
            row_start = np.repeat(offsets[:-1], np.diff(offsets))[x]
            first[x[x - row_start >= 4]] = True
        start = np.flatnonzero(first[:n])
        return start, np.r_[start[1:], n].astype(np.int64), np.searchsorted(offsets, start, side="right") - 1

    def look_up(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The held number of every piece of the texts, and its row."""
        start, end, row = self.pieces(data, offsets)
        keys, one, inverse = np.unique(W.hash_words(data, start, end, fold=None), return_index=True, return_inverse=True)
        if self.held > HELD_BYTES:
            self.forget()
        at = np.minimum(np.searchsorted(self.hashes, keys), max(len(self.hashes) - 1, 0))
        missing = self.hashes[at] != keys if len(self.hashes) else np.ones(len(keys), bool)
        if missing.any():
            raw, at = data.tobytes(), one[missing]
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            self.learn([raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist())], edge[start[at]] | edge[end[at]], keys[missing])
        return self.numbers[np.searchsorted(self.hashes, keys)][inverse], row


#: Bytes of characters that no tokenizer here takes for a blank: ASCII signs, and lead bytes of
#: two-byte characters (from U+00C0 on) and of CJK and Hangul three-byte ones.
_PLAIN, _TWO, _THREE, _TAIL = (np.zeros(256, bool) for _ in range(4))
_PLAIN[0x21:0x7F] = True
_TWO[0xC3:0xE0] = True
_THREE[0xE4:0xEE] = True
_TAIL[0x80:0xC0] = True


def _codec(a_file: str, b_file: str) -> Codec:
    if (a_file, b_file) not in _codecs:
        _codecs[a_file, b_file] = Codec(a_file, b_file)
    return _codecs[a_file, b_file]


def _spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with a space before every text that isn't null or empty."""
    data, offsets = W.utf8(column)
    some = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][some], 0x20), np.r_[0, np.cumsum(np.diff(offsets) + some)]


def _entries(codec: Codec, data: np.ndarray, offsets: np.ndarray, first_slot: int) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """Document columns of a slice, and its entries: pair, slot, links."""
    n = len(offsets) - 1
    piece, row = codec.look_up(data, offsets)
    wrong = np.bincount(row[codec.facts[piece, 3] == 0], minlength=n) > 0
    piece, row = piece[~wrong[row]], row[~wrong[row]]
    edge = np.searchsorted(row, np.arange(n + 1))
    text = codec.text
    as_list = piece.tolist()
    digest = [hashlib.sha256(b"".join([text[p] for p in as_list[x:y]])[:-1]).hexdigest() if y > x else "" for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
    key = np.sort(row * len(text) + piece)  # distinct pieces of each document
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.r_[new, len(key)])
    row_of, piece_of = np.divmod(key[new], max(len(text), 1))
    sizes = codec.facts[piece_of, 4]
    key = (codec.pairs[_ragged(codec.facts[piece_of, 5], sizes)] << 16) | np.repeat(row_of, sizes)  # at most 65536 rows a slice
    order = np.argsort(key)
    key, links = key[order], np.repeat(times, sizes)[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    links = np.add.reduceat(links, new) if len(new) else links
    pair, slot = key[new] >> 16, key[new] & 0xFFFF
    sums = {c: np.bincount(row, codec.facts[piece, k], minlength=n).astype(np.int64) for c, k in (("n_a", 0), ("n_b", 1), ("n_groups", 2), ("n_links", 4))}
    return sums | {"groups_sha256": digest}, pair, slot + first_slot, links


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    at = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(np.ascontiguousarray(data))])


def _containers(pair: np.ndarray, slot: np.ndarray, links: np.ndarray, n_slots: int) -> pa.RecordBatch:
    """One row a pair: popcount, links, container and planes; the entries come
    in any order."""
    order = np.argsort((pair << 16) | slot)
    pair, slot, links = pair[order], slot[order].astype(np.int64), links[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(pair)])
    which = np.repeat(np.arange(len(first)), n)
    width = -(-n_slots // 8)
    dense = 2 * n > width
    size = np.where(dense, width, 2 * n)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    thin = ~dense[which]
    rank = np.arange(len(pair)) - first[which] if len(first) else np.zeros(0, np.int64)
    place = at[which] + 2 * rank
    out[place[thin]], out[place[thin] + 1] = slot[thin] & 0xFF, slot[thin] >> 8
    fat = ~thin
    np.bitwise_or.at(out, at[which][fat] + (slot[fat] >> 3), np.left_shift(1, slot[fat] & 7).astype(np.uint8))
    most = np.maximum.reduceat(links, first) if len(first) else np.zeros(0, np.int64)
    planes = np.ceil(np.log2(most + 1)).astype(np.int64)
    wide = -(-n // 8)
    plane_size = planes * wide
    plane_at = np.cumsum(plane_size) - plane_size
    bits = np.zeros(int(plane_size.sum()) * 8, bool)
    for k in range(int(planes.max()) if len(planes) else 0):
        on = np.flatnonzero((links >> k) & 1)
        bits[(plane_at[which[on]] + k * wide[which[on]]) * 8 + rank[on]] = True
    total = np.add.reduceat(links, first) if len(first) else links
    return pa.RecordBatch.from_arrays([pa.array(pair[first]), pa.array(n.astype(np.int32)), pa.array(total), _binary(out, size), _binary(np.packbits(bits, bitorder="little"), plane_size)],
                                      ["pair", "n_docs", "links", "container", "planes"])


def _read(n: np.ndarray, container: pa.Array, planes: pa.Array, n_slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and links of every entry of containers with n documents."""
    def buffers(column):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = pa.concat_arrays([column]) if column.offset else column
        column = column.cast(pa.large_binary())
        at = np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8), at

    data, at = buffers(container)
    width = -(-n_slots // 8)
    dense = 2 * n > width
    which = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    slot = np.zeros(len(which), np.int64)
    thin = np.flatnonzero(~dense[which])
    place = at[which[thin]] + 2 * (thin - first[which[thin]])
    slot[thin] = data[place].astype(np.int64) | (data[place + 1].astype(np.int64) << 8)
    if dense.any():
        rows = np.flatnonzero(dense)
        bits = np.unpackbits(data[_ragged(at[rows], np.full(len(rows), width))].reshape(len(rows), width), axis=1, bitorder="little")
        slot[dense[which]] = np.nonzero(bits)[1]
    data, at = buffers(planes)
    wide = -(-n // 8)
    depth = np.where(n > 0, np.diff(at) // np.maximum(wide, 1), 0)
    links = np.zeros(len(which), np.int64)
    rank = np.arange(len(which)) - first[which] if len(n) else np.zeros(0, np.int64)
    for k in range(int(depth.max()) if len(depth) else 0):
        on = np.flatnonzero(depth[which] > k)
        byte = data[at[which[on]] + k * wide[which[on]] + (rank[on] >> 3)]
        links[on] += ((byte >> (rank[on] & 7)) & 1).astype(np.int64) << k
    return which, slot, links


def postings(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written posting table.  Rows of documents (``pair`` null): block,
    slot, id, n_a, n_b, n_groups, n_links, groups_sha256.  Rows of pairs: block,
    n_slots of the block, pair, n_docs, links, container, planes.  The files are
    those of the driver; they go to the executors with the job."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    files = [shipped(docs.sparkSession, f) for f in (a_file, b_file)]
    names = ["block", "slot", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_slots", "pair", "n_docs", "links", "container", "planes"]

    def encode(batches):
        codec = _codec(*map(SparkFiles.get, files))
        block, slots, held, n_held = TaskContext.get().partitionId() << 32, 0, [], 0

        def closed():
            rows = _containers(*(np.concatenate(x) for x in zip(*held)), slots) if held else None
            for i in range(0, rows.num_rows if rows else 0, 50_000):
                part = rows.slice(i, 50_000)
                m = part.num_rows
                empty = [pa.nulls(m, t) for t in (pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), *empty, pa.array(np.full(m, slots, np.int32)), *(part.column(c) for c in range(5))], names)

        for batch in batches:
            id_type = batch.column(0).type
            data, offsets = _spaced(batch.column(1))
            for i, j in W.slices(offsets, STEP):
                for x in range(i, j, 1 << 16):
                    y = min(j, x + (1 << 16))
                    if held and (n_held >= BLOCK_ENTRIES or slots + y - x > 1 << 16):
                        yield from closed()
                        block, slots, held, n_held = block + 1, 0, [], 0
                    sums, *entries = _entries(codec, data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x], slots)
                    m = y - x
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), pa.array(np.arange(slots, slots + m, dtype=np.int32)), batch.column(0).slice(x, m), *(pa.array(sums[c]) for c in names[3:7]), pa.array(sums["groups_sha256"], pa.string()),
                                                      *(pa.nulls(m, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names)
                    held.append([e.astype(t) for e, t in zip(entries, (np.int64, np.int32, np.int32))])
                    slots, n_held = slots + m, n_held + len(entries[0])
        yield from closed()

    schema = f"block long, slot int, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_slots int, pair long, n_docs int, links long, container binary, planes binary"
    return written(source.mapInArrow(encode, schema), "pair-postings")


def pair_counts(table: DataFrame) -> DataFrame:
    """pair, a, b, n_docs, n_links, and ``best``: no pair of the same A id is in
    more documents."""
    pairs = table.where("pair is not null").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("links").alias("n_links"))
    pairs = written(pairs.select("pair", F.expr(f"shiftright(pair, {SECOND.bit_length() - 1})").alias("a"), F.col("pair").bitwiseAND(F.lit(SECOND - 1)).alias("b"), "n_docs", "n_links"), "pair-counts")
    top = pairs.groupBy("a").agg(F.max("n_docs").alias("top"))  # a row for each A id at most
    return pairs.join(top, "a").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("top")).alias("best"))


def score(table: DataFrame, counts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a document: its columns of ``postings`` with ``n_best`` (links
    whose pair is best for its A id) and ``count_sum`` (documents of the pair,
    over links)."""
    kind = table.schema["id"].dataType.simpleString()
    rows = table.where("pair is not null").select("block", "n_slots", "pair", F.col("n_docs").alias("n"), "container", "planes")
    told = rows.join(counts.select("pair", "n_docs", "best"), "pair").drop("pair")

    def sums(batches):
        held: list = []

        def given():
            block, best, total = held
            on = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(on), block)), pa.array(on.astype(np.int32)), pa.array(best[on]), pa.array(total[on])], ["block", "slot", "n_best", "count_sum"])

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = np.r_[0, np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks)] if len(blocks) else [0]
            for i, j in zip(edges[:-1], edges[1:]):
                part = batch.slice(i, j - i)
                n_slots = part.column("n_slots")[0].as_py()
                if held and held[0] != blocks[i]:
                    yield given()
                    held = []
                held = held or [blocks[i], np.zeros(n_slots, np.int64), np.zeros(n_slots, np.int64)]
                which, slot, links = _read(part.column("n").to_numpy().astype(np.int64), part.column("container"), part.column("planes"), n_slots)
                best = part.column("best").to_numpy(zero_copy_only=False)[which]
                np.add.at(held[1], slot[best], links[best])
                np.add.at(held[2], slot, links * part.column("n_docs").to_numpy()[which])
        if held:
            yield given()

    # a block's rows stand together in one task, in any order
    by_block = told.repartition("block").sortWithinPartitions("block")
    scored = by_block.mapInArrow(sums, "block long, slot int, n_best long, count_sum long")
    own = table.where("pair is null").select("block", "slot", F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    out = own.join(scored, ["block", "slot"], "left")
    zero = F.lit(0).cast("long")
    return out.select(F.col(id_col).cast(kind).alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``postings``, ``pair_counts`` and ``score`` in one."""
    table = postings(docs, a_file, b_file, id_col, text_col)
    return score(table, written(pair_counts(table), "pair-best"), id_col)
