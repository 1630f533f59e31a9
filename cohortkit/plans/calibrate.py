"""Blend -> global cut -> per-group calibration choice -> final decisions.

Input: a wide OOF table and a wide scoring table with ``p_<model>`` columns,
the label on the OOF rows and the candidate grouping columns on both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.columns import weighted_sum
from cohortkit.operators.ensemble import apply_cuts, best_cut, decisions, group_cuts, pick_calibration

# Calibration candidates, in the order they are tried.
CANDIDATES = ["DeckSide", "CabinDeck", "Destination", "HomeDestination", "CryoHome", "ServicesUsed"]


def calibrated_decisions(oof: DataFrame, test: DataFrame, weights: Mapping[str, float], candidates: Sequence[str],
                         label: str = "y", id_col: str = "id", min_count: int = 100) -> tuple[DataFrame, dict]:
    """Decisions for the scoring rows plus a small dict of the scalars chosen
    (global cut and accuracy, chosen column or None)."""
    o = oof.withColumn("p", weighted_sum(weights)).withColumn(label, F.col(label).cast("int"))
    t = test.withColumn("p", weighted_sum(weights))
    g = best_cut(o, score="p", label=label).first()          # one row of scalars
    cut, acc = float(g["cut"]), float(g["accuracy"])
    choice = pick_calibration(o, candidates, cut, acc, min_count=min_count, label=label)
    chosen = choice.where("chosen").select("candidate").collect()   # at most one row
    info = {"cut": cut, "accuracy": acc, "column": chosen[0]["candidate"] if chosen else None}
    if info["column"] is None:
        out = decisions(t, cut)
    else:
        cuts = group_cuts(o, info["column"], cut, min_count=min_count, label=label)
        out = apply_cuts(t, info["column"], cuts, cut)
    return out.select(id_col, F.col("decision")), info
