"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, the
source's target over its size.  The whole part is taken as it is; the
fractional parts are rounded so that the source's words stay on target: two
documents are paired, word mass is moved at random from one to the other -
with odds that keep each document's expectation - until one of the two is
integral, and the other goes on to the next pair.  Groups of about ``fan``
documents are reduced so in parallel; the one document each leaves over goes to
the next level of a tree of fan-in ``fan``, until a source has one left.

That last document of a source takes the words that are missing
(``whole=False``: a cut copy of at most one document per source), or is rounded
at random with its probability (``whole=True``).

Native: sizes, targets, pairing and the tree are DataFrame expressions.  No
group grows with the input: a hot source only has more groups and levels.

Defined results: a null text has size 0, a null source is a source of its own
(last in order), a source of size 0 has target 0, an empty table gives no rows.
Rows equal in id, source, size and text are alike: they share their copies as
evenly as whole copies go.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import packed, running_sum, unit_random, written
from cohortkit.operators.windows import row_ranks
from cohortkit.operators.windows import prefix_sums

__all__ = ["targets", "allocate", "take"]

#: Sources up to which the table of targets (one short row a source) is broadcast.
BROADCAST_SOURCES = 100_000


def targets(sizes: DataFrame, share: float = 1.5, weights: Sequence[float] = (5.0, 2.0, 1.0), limit: float = 2.0) -> DataFrame:
    """Per source of ``sizes`` (source, size): ``source_size``, ``n_docs`` and
    ``target``: ``share`` of all words dealt by weight, no source above
    ``limit`` times its size.

    Sources take ``weights`` in turn, by code point, null last.  Resharing the
    excess by weight until none is above ends at min(limit * size, c * weight)
    with one c for all; with the sources in order of limit * size / weight, c is
    read off running sums."""
    per = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "sources")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = running_sum(per, [F.col("source").asc_nulls_last()], F.lit(1).cast("long"), "place").withColumn("weight", turn)
    ranked = written(ranked.withColumn("cap", F.col("source_size") * F.lit(float(limit))), "weights")
    total, all_weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    sums = prefix_sums(ranked, [], [F.col("cap") / F.col("weight"), F.col("place")], {"caps": "cap", "used": "weight"}, inclusive=False)
    level = (F.lit(float(share * (total or 0))) - F.col("caps")) / (F.lit(all_weights) - F.col("used"))
    fits = sums.select("place", level.alias("level"), (F.col("cap") / F.col("weight")).alias("at")).where("level <= at")
    c = fits.agg(F.min_by("level", F.struct("at", "place"))).first()[0]
    target = F.col("cap") if c is None else F.least(F.col("cap"), F.lit(c) * F.col("weight"))
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


def _step(state: Column, x: Column, seed: int) -> Column:
    """Pair the open document ``state.open`` with ``x`` (both: id, size, p and
    what rides along); one of them is settled."""
    i = state["open"]
    up = F.least(i["size"] * (1 - i["p"]), x["size"] * x["p"])
    down = F.least(i["size"] * i["p"], x["size"] * (1 - x["p"]))
    return F.when(i.isNull(), F.struct(x.alias("open"), state["done"].alias("done"))).otherwise(_move(state, x, up, down, unit_random(x["key"], i["key"], seed)))


def _with_p(item: Column, p: Column) -> Column:
    return F.struct(item["key"].alias("key"), item["size"].alias("size"), p.alias("p"), item["row"].alias("row"))


def _move(state: Column, x: Column, up: Column, down: Column, u: Column) -> Column:
    i = state["open"]

    def settle(done: Column, p: float, rest: Column) -> Column:
        return F.struct(rest.alias("open"), F.concat(state["done"], F.array(_with_p(done, F.lit(p)))).alias("done"))

    rise = F.when(up == i["size"] * (1 - i["p"]), settle(i, 1.0, _with_p(x, x["p"] - up / x["size"]))).otherwise(settle(x, 0.0, _with_p(i, i["p"] + up / i["size"])))
    fall = F.when(down == i["size"] * i["p"], settle(i, 0.0, _with_p(x, x["p"] + down / x["size"]))).otherwise(settle(x, 1.0, _with_p(i, i["p"] - down / i["size"])))
    return F.when(u * (up + down) < down, rise).otherwise(fall)


def _reduce(items: DataFrame, seed: int, name: str) -> DataFrame:
    """Settle all but one document of each (source, part)."""
    groups = items.groupBy("source", "part").agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
    kind = items.schema["item"].dataType.simpleString()
    empty = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast(f"array<{kind}>").alias("done"))
    return written(groups.select("source", "part", F.aggregate("items", empty, lambda s, x: _step(s, x, seed)).alias("state")), name)


def allocate(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5.0, 2.0, 1.0), limit: float = 2.0, whole: bool = False, fan: int = 128,
             seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each document: its id, ``text_hash``, ``source``, ``size``
    (words), ``source_size``, ``target`` (its source's), ``copies`` (not
    integral for the cut one alone) and ``taken`` (words)."""
    sizes = written(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long").alias("size")), "sizes")
    per = written(targets(sizes, share, weights, limit), "targets")
    n_sources, most = per.agg(F.count(F.lit(1)), F.max("n_docs")).first()
    side = per.select(F.col("source").alias("__source"), "source_size", "target", "n_docs")
    side = F.broadcast(side) if n_sources <= BROADCAST_SOURCES else side
    alike = sizes.groupBy("source", "id", "text_hash", "size").agg(F.count(F.lit(1)).alias("rows"))
    alike = alike.join(side, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    alike = alike.withColumns({"base": F.floor(each), "more": F.col("rows") * (each - F.floor(each))})
    alike = alike.withColumns({"certain": F.floor("more"), "p": F.col("more") - F.floor("more")})
    key = F.xxhash64("id", "text_hash", "size")
    row = F.struct("id", "text_hash", "size", "rows", "source_size", "target", "base", "certain")
    part = F.pmod(key, F.greatest(F.lit(1), F.ceil(F.col("n_docs") / fan)))
    # the level-0 part of a source with n documents is one of ceil(n / fan); each level divides the part by fan
    items = written(alike.select("source", part.alias("part"), F.struct(key.alias("key"), F.col("size").cast("double").alias("size"), "p", row.alias("row")).alias("item")), "items")
    clear = (F.col("item.p") <= 0) | (F.col("item.size") <= 0)
    done = [items.where(clear).select("source", F.col("item.row").alias("row"), F.lit(0.0).alias("x"))]
    open_items, parts = items.where(~clear), max(1, math.ceil((most or 0) / fan))
    level = 0
    while True:
        state = _reduce(open_items, seed + level, f"pairs{level}")
        done.append(state.select("source", F.explode("state.done").alias("d")).select("source", "d.row", F.col("d.p").alias("x")))
        left = state.where("state.open is not null").select("source", F.floor(F.col("part") / fan).cast("long").alias("part"), F.col("state.open").alias("item"))
        if parts <= 1:
            break
        open_items, parts, level = left, math.ceil(parts / fan), level + 1
    last = F.col("item.p")
    if whole:
        last = (unit_random(F.col("item.key"), seed, "last") < last).cast("double")
    done.append(left.select("source", F.col("item.row").alias("row"), last.alias("x")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    place = F.explode(F.sequence(F.lit(1).cast("long"), F.col("row.rows")))
    extra = F.when(F.col("place") <= F.col("row.certain"), 1.0).when(F.col("place") == F.col("row.certain") + 1, F.col("x")).otherwise(0.0)
    copies = F.col("row.base") + extra
    return out.withColumn("place", place).select(
        F.col("row.id").alias(id_col), F.col("row.text_hash").alias("text_hash"), "source", F.col("row.size").alias("size"),
        F.col("row.source_size").alias("source_size"), F.col("row.target").alias("target"), copies.alias("copies"),
        F.round(copies * F.col("row.size")).cast("long").alias("taken"))


def take(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: ``docs`` with all columns, each row as often as it is
    taken (whole copies).  Rows equal in source, id and text share their copies: as
    many each, the first rows of the written input one more where that leaves a rest."""
    rows = packed(docs, "mixed")
    keys = [F.col("doc")[source_col].alias("source"), F.col("doc")[id_col].alias("id"), F.xxhash64(F.col("doc")[text_col]).alias("text_hash")]
    got = allocate(rows.select(F.col("doc")[id_col].alias("id"), F.col("doc")[text_col].alias("text"), F.col("doc")[source_col].alias("source")),
                   whole=True, seed=seed, id_col="id", text_col="text", source_col="source", **how)
    per = got.groupBy(F.col("source").alias("s"), F.col("id").alias("i"), F.col("text_hash").alias("h")).agg(F.sum("copies").cast("long").alias("copies"), F.count(F.lit(1)).alias("alike"))
    per = written(per.where("copies > 0"), "copies")
    placed = written(rows.select("row", *keys).join(per, F.expr("source <=> s and id <=> i and text_hash = h")).select("row", "source", "id", "text_hash", "copies", "alike"), "placed")
    ranked = row_ranks(placed.where("alike > 1"), ["source", "id", "text_hash"], ["row"], "rank")
    shared = ranked.select("row", (F.floor(F.col("copies") / F.col("alike")) + (F.col("rank") < F.col("copies") % F.col("alike")).cast("long")).alias("copies"))
    taken = placed.where("alike = 1").select("row", "copies").unionByName(shared.where("copies > 0"))
    return rows.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
