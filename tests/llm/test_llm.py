"""Corpus operators against brute force on small fixtures."""

import hashlib
import os
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import decontaminate, fingerprint, license_scan, line_dedup, mixing, near_dedup, queries, quality, sharding, suffix_tree, token_shards

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


EDGE = [(1, None, "a"), (2, "", None), (3, "one two three four five six seven eight nine ten eleven", "a"), (3, "one two three four five six seven eight nine ten eleven", "a"),
        (None, "lonely text", "b"), (4, "x" * 50_000 + " end", "b"), (5, "zero one two three four five six seven eight nine ten", "a")]


@pytest.fixture(scope="module")
def real(spark):
    if not os.path.isdir(SF):
        pytest.skip("generated tables not present")
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")


def test_scan_edges(spark):
    bench = spark.createDataFrame([(7, "ONE two three four five six seven eight nine ten"), (8, "Lonely, text!"), (9, None), (7, "text")], "item_id long, text string")
    for block in (1 << 20, 10):  # one block, several blocks
        got = sorted((r.doc_id or -1, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.scan(_docs(spark, EDGE), bench, block_bytes=block).collect())
        assert got == [(-1, 2, 2, ("7", "8")), (1, 0, 0, ()), (2, 0, 0, ()), (3, 11, 10, ("7",)), (3, 11, 10, ("7",)), (4, 2, 0, ()), (5, 11, 10, ("7",))]
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(_docs(spark, EDGE), bench, action="cut").collect()}
    assert cut[5] == "zero " and cut[3] == " eleven" and cut[1] is None
    assert decontaminate.decontaminate(_docs(spark, EDGE), bench).count() == 3
    assert decontaminate.scan(_docs(spark, EDGE).limit(0), bench).count() == 0
    assert decontaminate.decontaminate(_docs(spark, EDGE), bench.limit(0)).count() == len(EDGE)


def test_mix_targets_and_totals(spark, real):
    got = mixing.allocate(real[0]).toPandas()
    sizes = got.groupby("source")["size"].sum()
    names = sorted(sizes.index)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest = dict.fromkeys(names, 0.0), 1.5 * sizes.sum()
    while rest > 1e-6:  # deal, stop at twice the size, deal the excess again
        free = [s for s in names if target[s] < 2 * sizes[s]]
        total, left = sum(weight[s] for s in free), 0.0
        for s in free:
            t = target[s] + rest * weight[s] / total
            left += max(0.0, t - 2 * sizes[s])
            target[s] = min(t, 2.0 * sizes[s])
        rest = left
    for s, rows in got.groupby("source"):
        assert abs(rows.target.iloc[0] - target[s]) < 1e-3 and abs(rows.taken.sum() - target[s]) <= 1
        assert (rows.copies % 1 > 0).sum() <= 1 and (rows.taken <= 2 * rows["size"]).all()
    again = mixing.allocate(real[0].repartition(5)).toPandas()
    assert sorted(zip(again.doc_id, again.taken)) == sorted(zip(got.doc_id, got.taken))


def test_mix_edges(spark):
    docs = _docs(spark, EDGE)
    assert mixing.allocate(docs).count() == len(EDGE) and mixing.allocate(docs.limit(0)).count() == 0
    assert mixing.take(docs).columns == docs.columns


def test_quality_rejects_junk_and_survives_edges(spark):
    rows = [(i, " ".join(f"word{(i * 7 + j * 3) % 40}" for j in range(30)) + (" BAD!! BAD!!" if i % 4 == 0 else ""), "s") for i in range(200)]
    docs = _docs(spark, rows + [(500, None, None), (501, "", "s")])
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 200, 3)] + [(1, None)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.resample(docs, labels, F.col("quality") == 1, keep=152).collect()}
    bad = {i for i in range(0, 200, 4)}
    assert len(kept & bad) <= 0.1 * len(bad) and len(kept - bad) >= 148
    assert quality.resample(docs, labels.limit(0), F.col("quality") == 1).count() == 202
    assert quality.resample(docs.limit(0), labels, F.col("quality") == 1).count() == 0


def test_kth_largest(spark):
    values = [1.0, 5.0, 5.0, 5.0, -3.0, 2.5, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in range(1, 8):
        assert quality.kth_largest(df, "v", k) == sorted(values)[-k]


def test_near_dedup_against_brute_force(spark, real):
    got = {r.doc_id: r.class_id for r in near_dedup.classes(real[0]).collect()}
    sets = {}
    for r in real[0].collect():
        w = WORD.findall(r.text.lower())
        sets[r.doc_id] = Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = sum((sets[a] & sets[b]).values())
            if both and both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= 0.8:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    assert got == {i: root(i) for i in ids}
    edge = near_dedup.classes(_docs(spark, EDGE)).collect()
    assert len(edge) == len(EDGE) and near_dedup.classes(_docs(spark, EDGE).limit(0)).count() == 0


def test_keep_one_removes_rows_not_ids(spark):
    one, two, three = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(3, one, "s"), (3, one, "s"), (9, one, "s"), (None, two, "s"), (None, two, "s"), (7, three, "s"), (8, one + " more", "s"), (8, two + " tail", "s"), (8, "text of its own", "s"), (None, three, "s"), (1, None, "s"), (1, None, "s")]
    got = near_dedup.keep_one(_docs(spark, rows))
    assert got.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    # one: id 3 once, without 9 and the row of 8 like it; two: the row with an id goes before the null ones; three: 7
    assert sorted(((r.doc_id or 0), r.text or "") for r in got.collect()) == sorted([(3, one), (8, two + " tail"), (7, three), (8, "text of its own"), (1, ""), (1, "")])
    nulls = near_dedup.keep_one(_docs(spark, [(None, two, "s")] * 3)).collect()
    assert [r.text for r in nulls] == [two]
    named = near_dedup.classes(_docs(spark, rows)).collect()
    assert sorted(((r.doc_id or 0), r.class_id or 0) for r in named) == sorted([(3, 3), (3, 3), (9, 3), (0, 8), (0, 8), (7, 7), (8, 3), (8, 8), (8, 8), (0, 7), (1, 1), (1, 1)])
    assert near_dedup.keep_one(_docs(spark, rows).limit(0)).count() == 0


def test_sharding_fits(spark, real):
    for limit in (4 << 10, 64 << 10):
        got = sharding.assign(real[0], limit).toPandas()
        assert len(got) == real[0].count()
        per = got.groupby("shard").agg(b=("n_bytes", "sum"), n=("doc_id", "size"), said=("shard_bytes", "first"))
        assert (per.b == per.said).all() and ((per.b <= limit) | (per.n == 1)).all()
    same = _docs(spark, [(1, "abcdefgh", "s")] * 9 + [(2, "q" * 40, "s")])
    per = sharding.assign(same, 20).groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in per) == 10 and all(r.b <= 20 or r.n == 1 for r in per)
    assert sharding.assign(same.limit(0), 20).count() == 0


def test_pipeline_shards_fit(spark, monkeypatch):
    monkeypatch.setattr(queries, "SHARD_BYTES", 100)
    rows = [(1, f"copy {i:03d}", "s") for i in range(40)] + [(None, f"lost {i:03d}", "s") for i in range(40)] + [(1, "w" * 70, "s"), (1, "v" * 300, "s"), (2, None, "s"), (2, None, "s")] + [(i, "x" * 30, "s") for i in range(10, 40)]
    docs = _docs(spark, rows)
    got = corpus_pipeline.shard(spark, docs, "").toPandas()
    assert list(got.columns) == [*docs.columns, "shard", "depth", "shard_bytes", "shard_docs", "single"]
    assert sorted(t or "" for t in got.text) == sorted(t or "" for _, t, _ in rows)
    per = got.assign(b=got.text.fillna("").str.len()).groupby("shard").agg(b=("b", "sum"), n=("b", "size"), said=("shard_bytes", "first"), docs=("shard_docs", "first"), single=("single", "first"))
    assert (per.b == per.said).all() and (per.n == per.docs).all() and (per.single == (per.b > 100)).all()
    assert ((per.b <= 100) | (per.n == 1)).all()


def test_fingerprints(spark, real):
    got = {r.doc_id: r for r in queries.op8_fingerprint(spark, SF).collect()}
    text = {r.doc_id: r.text for r in real[0].collect()}
    order = sorted(text, reverse=True)
    for i, a in enumerate(order):
        b, half = text[order[(i + 1) % len(order)]], len(text[a]) // 2
        edited = text[a][: len(text[a]) - half] + b[:half]
        assert got[a].n_chars == len(text[a]) and got[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert np.mean([r.near_edited for r in got.values()]) > 0.2
    edge = fingerprint.with_next(_docs(spark, EDGE)).count()
    assert edge == len(EDGE) and fingerprint.with_next(_docs(spark, EDGE).limit(0)).count() == 0


def test_line_dedup(spark):
    long = "the quick brown fox jumps over the lazy dog while the cat sleeps on a warm window sill and dreams of fish " * 3
    docs = _docs(spark, [(1, long + "\nother line here\n\n", "s"), (2, "start\n" + long.replace("warm", "warn"), "s"), (3, long.upper() + "\n...", "s"), (4, None, "s")])
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.marks(docs).collect()}
    assert got[1] == (4, []) and got[3] == (2, [0]) and got[4] == (1, []) and got[2][0] == 2
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert texts[3] == "..." and texts[4] is None


def test_license_scan(spark):
    docs = _docs(spark, [(1, "Licensed under CC BY-NC 4.0.", "s"), (2, "plain text\nmore of it", "s"), (3, "some words that go on and on for a while\nReleased under the MIT License.", "s"), (4, None, "t")])
    got = {r.doc_id: r for r in license_scan.scan(docs, F.concat_ws("/", "source", "lang", "doc_id")).collect()}
    assert got[1].own == "CC-BY-NC-4.0" and got[1].is_license_file and got[3].own == "MIT" and not got[3].is_license_file
    assert got[2].license == "CC-BY-NC-4.0" and got[2].from_dir == "s/en" and got[4].license is None


def test_permutation_and_round_trip(spark, real):
    for n in (1, 2, 3, 17, 1000):
        slots = token_shards.permute(np.arange(n), n, 5)
        assert sorted(slots) == list(range(n)) and (token_shards.invert(slots, n, 5) == np.arange(n)).all()
    if not os.path.exists(queries.VOCABULARY):
        pytest.skip("no vocabulary")
    got = token_shards.write_shards(real[0], queries.VOCABULARY, length=128, shard_slots=100).toPandas().sort_values("sequence")
    stream = np.concatenate([token_shards.read_slot(f, o, 128) for f, o in zip(got.file, got.offset)])[: got.n_tokens.sum()]
    texts = [token_shards.encoder(queries.VOCABULARY).decode(x[:-1].tolist()) for x in np.split(stream, np.flatnonzero(stream == 50256) + 1)[:-1]]
    assert sorted(texts) == sorted(r.text for r in real[0].collect())


def test_suffix_tree(spark):
    docs = _docs(spark, [(i, f"alpha beta gamma w{i} alpha beta gamma", "s") for i in range(60)] + [(99, None, "s")])
    tree, counts = suffix_tree.train(docs, p_context=0.01, p_entry=0.005)
    got = {r.doc_id: r for r in suffix_tree.score(docs, tree, counts).collect()}
    assert got[99].n_tokens == 1 and got[5].n_tokens == 8 and got[5].n_known == 8 and got[5].train_tokens == 60 * 8 + 1
    tokens = Counter(t for i in range(60) for t in (*f"alpha beta gamma w{i} alpha beta gamma".split(), None)) + Counter([None])
    n, v = sum(tokens.values()), len(tokens)
    base = sum(np.log10((tokens[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ("alpha", "beta", "gamma", "w5", "alpha", "beta", "gamma", None))
    assert abs(got[5].base_score - base) < 1e-9 and got[5].score > base
