"""Wrappers, pair bitmaps and whitening against brute force; clashing columns
and equal rows in the operators that return documents."""

import hashlib
import html
import os
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import line_dedup, mixing, near_dedup, pair_bitmaps, queries, whitening, wrappers

SF = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def have():
    if not os.path.isdir(SF):
        pytest.skip("generated tables not present")


# ---- wrappers ------------------------------------------------------------------------------------------
def _texts(spark, pages):
    rows = [(i, "http://h.example/x", p) for i, p in enumerate(pages)]
    return [r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGE).repartition(3)).orderBy("page_id").collect()]


def test_extract_equals_brute_force(spark, have):
    pages = spark.read.parquet(f"{SF}/pages.parquet")

    def brute(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)

    got = {r.page_id: (r.text, r.n_chars) for r in queries.op11_wrappers(spark, SF).collect()}
    assert got == {r.page_id: (brute(r.html), len(brute(r.html))) for r in pages.collect()}


def test_extract_without_article(spark):
    pages = [f'<body><div class="top">Site</div><ul class=menu><li><a href=x>Home</a></ul><div id=c><h2>T{i}</h2><p>para &lt;b&gt; {i}<p>two<table><tr><td>a{i}<td>b</table></div>'
             f'<div class="comments"><p>me {i}</p></div><form>q<input></form>' for i in range(4)]
    assert _texts(spark, pages) == [f"T{i}\npara <b> {i}\ntwo\na{i}\nb" for i in range(4)]
    pages = [f'<form id=f><div class="sidebar">s</div><div class="layout has-sidebar"><main><h1>A{i}</h1><section class="comment-list"><article class=comment>c</article></section><p>b<br>c <i>d</i>e</p></main></div></form>' for i in range(3)]
    assert _texts(spark, pages) == [f"A{i}\nb c de" for i in range(3)]


def test_extract_syntax(spark):
    pages = ["a < b &amp; c <!-- no --> d <script>if(a<b)</script>e<a title='x>y' href=z>f</a> <p title=\"un>closed</p>g", "<![CDATA[x]]>t<br/>u</br>v<unfinished a", "",
             "<article><h1>Only</h1><aside>no</aside><header><nav>n</nav>by me</header><footer>f</footer>x&#10;&nbsp;y</article>after", "<div>" * 3000 + "x" + "</div>" * 3000 + "<p>y</p>"]
    assert _texts(spark, pages) == ["a < b & c d ef\nclosed\ng", "t u v", "", "Only\nby me\nx y", "x\ny"]


def test_extract_edges(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "http://x/", "<p>a</p>"), (2, "nohost", ""), (2, "nohost", "t"), (2, "nohost", "t")], PAGE).selectExpr("*", "1 as text", "2 as host", "3 as id", "4 as flags")
    got = sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in wrappers.extract(rows).collect()))
    assert got == [(0, "http://x/", "a", 1), (1, "", "", 0), (2, "nohost", "", 0), (2, "nohost", "t", 1), (2, "nohost", "t", 1)]
    assert wrappers.extract(rows.limit(0)).count() == 0


def test_wrappers_merge_in_any_order():
    pages = ["<div class=a><p>x</p><p>y</p></div><ul><li>1</ul>", "<ul><li>1<li>2</ul><div class=a><h2>t</h2><p>z</p><h2>u</h2><p>w</p></div>", "<div class=b>q</div>", "".join(f"<div class=c{chr(97 + i // 26)}{chr(97 + i % 26)}>t</div>" for i in range(100))]

    def merged(order):
        whole = wrappers._parsed(pages[order[0]])
        for i in order[1:]:
            whole.add(wrappers._parsed(pages[i]))
        return wrappers.flags(whole)

    assert merged([0, 1, 2, 3]) == merged([3, 1, 0, 2]) == merged([2, 3, 1, 0])


# ---- pair bitmaps --------------------------------------------------------------------------------------
def _align_brute(rows):
    codec = pair_bitmaps.Codec(queries.TOKENIZER_A, queries.TOKENIZER_B)
    docs, counts = [], Counter()
    for i, text in rows:
        a = codec.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = codec.b.encode(text) if text else []
        parts = [[bytes(data[at[t] : at[t + 1]]) for t in ids] for ids, data, at in ((a, codec.a_data, codec.a_at), (b, codec.b_data, codec.b_at))]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            docs.append((i, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(t) for t in p]).tolist() for p in parts]
        starts = [[0, *e[:-1]] for e in ends]
        links = [(x, y) for x, s, e in zip(a, starts[0], ends[0]) for y, t, u in zip(b, starts[1], ends[1]) if max(s, t) < min(e, u)]
        groups, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            own = []
            for k, ids in enumerate((a, b)):
                stop = ends[k].index(cut) + 1
                own.append(",".join(map(str, ids[at[k] : stop])))
                at[k] = stop
            groups.append("|".join(own))
        docs.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return sorted(((d[0], d[1], d[2], d[3], len(d[4]), sum(counts[p] == top[p[0]] for p in d[4]), sum(counts[p] for p in d[4]), d[5]) for d in docs), key=str)


def test_align_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    signs = ["a", "b", " ", "  ", "\n", "é", "中", " ", "▁", "　", "̀", "'s", "1", "23", "<|endoftext|>", "<s>", "<0x41>", "ü", "\t", "😀", ".", "!", "the", "ing", "\x00", "\x85", "한", "﻿", "ﬁ"]
    rows = [(1, None), (2, ""), (3, " "), (4, "hello world"), (4, "hello world"), (None, "a b c"), (5, "x" * 3000), (6, "a▁b c"), (7, "  two  spaces ")]
    rows += [(100 + i, "".join(rng.choice(signs) for _ in range(rng.randint(1, 40)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as block", "1 as pair", "2 as slot")
    got = pair_bitmaps.align(docs.repartition(3), queries.TOKENIZER_A, queries.TOKENIZER_B)
    assert sorted(map(tuple, got.collect()), key=str) == _align_brute(rows)
    assert pair_bitmaps.align(docs.limit(0), queries.TOKENIZER_A, queries.TOKENIZER_B).count() == 0


def test_containers_round_trip():
    rng = np.random.default_rng(2)
    for n_slots in (1, 9, 500, 40_000):
        size = min(n_slots * 3, 20_000)
        entries = {(int(p), int(s)): int(k) for p, s, k in zip(rng.integers(0, 4, size), rng.integers(0, n_slots, size), rng.integers(1, 3000, size))}
        pair, slot = (np.array([k[i] for k in entries]) for i in (0, 1))
        rows = pair_bitmaps._containers(pair, slot, np.array(list(entries.values())), n_slots)
        which, slots, links = pair_bitmaps._read(rows.column("n_docs").to_numpy().astype(np.int64), rows.column("container"), rows.column("planes"), n_slots)
        assert {(int(rows.column("pair").to_numpy()[w]), int(s)): int(k) for w, s, k in zip(which, slots, links)} == entries


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "the cat the cat"), (2, "the cat"), (3, "dog")], "doc_id long, text string")
    table = pair_bitmaps.postings(docs, queries.TOKENIZER_A, queries.TOKENIZER_B)
    counts = pair_bitmaps.pair_counts(table).collect()
    assert sum(r.n_links for r in counts) == sum(r.n_links for r in table.where("pair is null").collect())
    assert sorted((r.n_docs, r.n_links) for r in counts)[-1] == (2, 3) and all(r.best for r in counts if r.n_docs == 2)


# ---- whitening -----------------------------------------------------------------------------------------
@pytest.mark.parametrize("name", ["random", "degenerate", "decay", "close", "zero", "one"])
def test_spectrum(name):
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    x = rng.standard_normal((48, 60))
    a = {"random": x @ x.T, "degenerate": np.diag([5.0, 5, 5, 1, 1, 0, 0]), "decay": turn @ np.diag(10.0 ** -np.arange(20)) @ turn.T, "close": turn @ np.diag(1 + 1e-9 * np.arange(20)) @ turn.T, "zero": np.zeros((3, 3)), "one": np.array([[2.0]])}[name]
    a = (a + a.T) / 2
    values, vectors = whitening.spectrum(a)
    exact = np.linalg.eigvalsh(a)[::-1]
    scale = max(abs(exact).max(), 1e-300)
    assert np.abs(values - exact).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() <= 1e-13
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * scale


def test_whiten_equals_numpy(spark, have):
    pdf = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.floor(64 * np.stack(pdf.embedding).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    z = x - sums / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = z @ vectors[:, :32] / np.sqrt(values[:32])
    got = queries.op13_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    white = got.whitened.to_numpy().reshape(n, 32)
    assert np.abs(white * np.sign((white * want).sum(axis=0)) - want).max() < 1e-8
    assert (got.deviation.to_numpy().reshape(n, 32)[:, 0] == ((n * x - sums) ** 2).sum(axis=1)).all()
    assert np.allclose(got.explained.to_numpy()[:32], values[:32] / values.sum()) and got.identity_error.iloc[0] < 1e-10 and got.n.iloc[0] == n


def test_whiten_edges(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -1.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, []), (7, [1.0]), (8, [1e30, 0.0]), (9, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "'x' as component", "2 as id")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (9, 1), (9, 2)] and all(r.n == 4 for r in got)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert all(r.whitened is None and r.explained is None and r.deviation == 0 for r in whitening.whiten(df.where("vec_id = 1")).collect())


# ---- documents keep their columns ------------------------------------------------------------------------
def _clashing(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    names = ["__row", "row", "doc", "__hash", "__id", "__copies", "copies", "hash", "n_bytes", "removed", "root", "id", "size"]
    return docs.selectExpr("*", *[f"'X{i}' as `{c}`" for i, c in enumerate(names)])


ROWS = [(1, "one two three four five six seven", "a"), (1, "one two three four five six seven", "b"), (2, "one two three four five six seven eight", "a"), (None, "lonely", None), (3, None, "a"), (4, "", "b"),
        (5, "one two three four five six seven", "b"), (6, "words " * 300, "a"), (6, "words " * 300, "a")]


@pytest.mark.parametrize("stage", [near_dedup.keep_one, mixing.take, line_dedup.dedup_lines, lambda d: corpus_pipeline.shard(d.sparkSession, d, SF)])
def test_clashing_columns_stay(spark, stage):
    docs = _clashing(spark, ROWS)
    got = stage(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    for r in got.collect():
        assert all(r[c] == f"X{i}" for i, c in enumerate(["__row", "row", "doc", "__hash", "__id", "__copies", "copies", "hash", "n_bytes", "removed", "root", "id", "size"]))


def test_sharding_stage_replaces_its_names(spark):
    docs = _clashing(spark, ROWS).selectExpr("*", "'mine' as shard", "7 as depth")
    got = corpus_pipeline.shard(spark, docs, SF)
    assert len(got.columns) == len(set(got.columns)) and got.count() == len(ROWS) and got.where("shard = 'mine'").count() == 0


def test_take_tells_equal_rows_of_two_sources_apart(spark):
    docs = _clashing(spark, [(1, "a b c d", "a"), (1, "a b c d", "b"), (2, "a b c d", "a"), (2, "a b c d", "a")])
    copies = Counter()
    for r in mixing.allocate(docs, whole=True).collect():
        copies[r.source] += int(r.copies)
    got = Counter(r.source for r in mixing.take(docs).collect())
    assert got == Counter({s: n for s, n in copies.items() if n}) and set(got) == {"a", "b"}


def test_stages_as_a_chain(spark, have):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, SF), "chain")
        now = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(now) <= ids and now, name
        if name in ("quality classifier", "near-dedup", "decontamination"):
            assert len(now) == len(set(now)) and docs.columns == columns
        ids = set(now)
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert all(stage(spark, empty, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)
    assert docs.where("shard is null").count() == 0 and docs.agg(F.max("shard_bytes")).first()[0] <= queries.PIPELINE_SHARD_BYTES


def test_token_blocks_are_compressed_together(spark, monkeypatch):
    """Texts of a block share one compressed value, which is smaller than one by
    text; the written stream doesn't depend on the size of a block."""
    from cohortkit.llm import queries, token_shards

    docs = spark.createDataFrame([(i if i % 9 else None, f"the same words again and again, number {i}" if i % 7 else None) for i in range(400)], "doc_id long, text string").coalesce(1)
    blocks = token_shards.tokenised(docs, queries.VOCABULARY, 50256).collect()
    assert len(blocks) == 1 and blocks[0]["size"] == sum(blocks[0]["sizes"]) and len(blocks[0]["id"]) == 400
    assert len(blocks[0]["ids"]) < sum(len(token_shards._packed(bytes(2 * n))) for n in blocks[0]["sizes"])

    def stream():
        got = token_shards.write_shards(docs, queries.VOCABULARY, length=64, shard_slots=10).toPandas().sort_values("sequence")
        ids = np.concatenate([token_shards.read_slot(f, o, 64) for f, o in zip(got.file, got.offset)])
        return ids[: got.n_tokens.sum()].tolist(), [[None if v is None or v != v else int(v) for v in x] for x in got.doc_ids]

    whole = stream()
    monkeypatch.setattr(token_shards, "_BLOCK", 64)
    assert stream() == whole and whole[0].count(50256) == 400


def test_slices_hold_few_rows_of_short_texts():
    """Signatures take memory by row, whatever its length."""
    from cohortkit.llm import words

    offsets = np.arange(2001) * 3
    cuts = list(words.slices(offsets, 1 << 18, 256))
    assert [i for i, _ in cuts] == list(range(0, 2000, 256)) and [j for _, j in cuts] == [*range(256, 2000, 256), 2000]
    assert list(words.slices(np.array([0, 9, 10, 30]), 10, 256)) == [(0, 2), (2, 3)]


def _edits(a, b):
    row, b = np.arange(len(b) + 1), np.array([ord(y) for y in b], dtype=int)
    for i, x in enumerate(a):
        step = np.r_[i + 1, np.minimum(row[:-1] + (b != ord(x)), row[1:] + 1)]
        row = np.minimum.accumulate(step - np.arange(len(step))) + np.arange(len(step))
    return int(row[-1])


@pytest.mark.parametrize("small", [128, 2])
def test_line_dedup_pairs_brute_force(spark, monkeypatch, small):
    """Buckets met at once and larger ones by hubs lose none of the near pairs."""
    monkeypatch.setattr(line_dedup, "_SMALL", small)
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{i}é" for i in range(60)]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 2, 3, 9, 40, 90, 150)]
    for t in list(texts):
        w = t.split()
        for k in (1, 2, 6):
            texts.append(" ".join([*w[:-1], *rng.choice(words, k)]))
            texts.append(" ".join([*w[k:], *w[:k]]))
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sims = [r.sim & (2**64 - 1) for r in df.select("doc_id", line_dedup.simhash(F.col("text")).alias("sim")).orderBy("doc_id").collect()]
    group = list(range(len(texts)))
    for j, b in enumerate(texts):
        for i, a in enumerate(texts[:j]):
            if (sims[i] ^ sims[j]).bit_count() <= 3 and _edits(a, b) <= int(max(len(a), len(b)) * (1 - 0.8) + 1e-9):
                group = [group[i] if g == group[j] else g for g in group] if group[i] < group[j] else [group[j] if g == group[i] else g for g in group]
    got = {r.doc_id: r.removed for r in line_dedup.marks(df).collect()}
    assert {i for i, r in got.items() if r} == {i for i, g in enumerate(group) if g != i} and any(got.values())


def test_line_dedup_distance_bounds(spark):
    """The bounds of the edit distance decide as the distance itself."""
    rng = np.random.default_rng(4)
    rows = []
    for n in (0, 1, 100, 256, 300, 512, 1000):
        for share in (0, 0.02, 0.1, 0.15, 0.19, 0.2, 0.21, 0.3, 0.9):
            for kind in range(3):
                a = "".join(rng.choice(list("abcdeé "), n))
                b = list(a)
                for _ in range(int(n * share)):
                    at = int(rng.integers(0, len(b) + 1))
                    b[at : at + (kind != 1)] = [] if kind == 2 else [str(rng.choice(list("abcdeé ")))]
                rows.append((len(rows), a, "".join(b)))
    rows += [(len(rows), "x" * 60 + rows[-1][1], rows[-1][1] + "y" * 60), (len(rows) + 1, "ab" * 300, "ba" * 300)]
    got = line_dedup._reached(spark.createDataFrame(rows, "a long, norm_a string, norm_b string").withColumn("b", F.col("a")), 0.8)
    assert {r.a for r in got.collect()} == {i for i, a, b in rows if _edits(a, b) <= int(max(len(a), len(b)) * (1 - 0.8) + 1e-9)}


def test_line_dedup_shuffles_near_members_only(spark, monkeypatch):
    """Members of a bucket that are near nobody go no further than its join."""
    sizes = {}
    real = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: sizes.setdefault(name, real(df, name)))
    rows = [(i, f"a{i % 7} b{i % 11}") for i in range(77)]  # short lines of few words meet in many buckets
    line_dedup.marks(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert "line-buckets" not in sizes and sizes["line-met"].count() < 77
