"""Unit changes seen as level shifts in a source's history."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators import sequence

#: Ratios between two writings of a quantity that a level shift can mean.
KNOWN_FACTORS = (10.0, 60.0, 100.0, 1000.0, 60000.0, 1e6)
#: Values of one history that are segmented together. Longer histories are cut into runs of this many by rank, twice.
RUN = 4096


def pelt(values: Sequence[float], penalty: float) -> list[int]:
    """Exact penalised changepoint search for shifts of the mean (squared error): the starts of segments after the first.

    Candidates that can no longer be optimal are pruned, which leaves the result exact. No values or one give none.
    """
    x = np.asarray(values, dtype=float)
    return _cuts(np.ones(len(x)), x, x * x, penalty)


def _cuts(widths: np.ndarray, sums: np.ndarray, squares: np.ndarray, penalty: float) -> list[int]:
    """The same over pieces that are not cut any further, each given by its number of values, their sum and that of their squares."""
    n = len(sums)
    if n < 2:
        return []
    s0, s1, s2 = (np.concatenate([[0.0], np.cumsum(v)]) for v in (widths, sums, squares))
    best, last, alive = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int), np.array([0])
    best[0] = -penalty
    for t in range(1, n + 1):
        width = s0[t] - s0[alive]
        cost = best[alive] + (s2[t] - s2[alive]) - (s1[t] - s1[alive]) ** 2 / width
        k = int(np.argmin(cost))
        best[t], last[t] = cost[k] + penalty, alive[k]
        alive = np.append(alive[cost <= best[t]], t)
    out, t = [], n
    while t > 0:
        t = int(last[t])
        if t:
            out.append(t)
    return out[::-1]


def known_factor(shift: float, tolerance: float = 0.1) -> float | None:
    """The known factor (or its inverse) that a shift of log10 levels means."""
    for f in KNOWN_FACTORS:
        if abs(abs(shift) - math.log10(f)) <= tolerance:
            return f if shift > 0 else 1 / f
    return None


def unit_shifts(rows: DataFrame, run: int = RUN) -> DataFrame:
    """Level shifts by a known factor in each history of (source, kind, at, id, value).

    Only positive values have a logarithm; others and nulls are left out. A history is ordered by (at, id) and cut into
    runs of ``run`` values by rank, so no source, however hot, lands in one task: ranks come from counts per source and
    minute, not from a window over the source. Longer histories are cut a second time, half a run further on, so each place lies
    well within a run; the cuts of both are then weighed against each other over the whole history, which has one row
    per piece there, under its one penalty. Out come (source, kind, at, id, factor): the row at which the level changes
    and the factor that reverses it. Ties in time are told apart by id; of rows alike in both the least value counts.
    """
    keys = ["source", "kind"]
    usable = rows.where((F.col("value") > 0) & F.col("at").isNotNull()).groupBy(*keys, "at", "id").agg(F.log10(F.min("value")).alias("x"))
    ranks = sequence.ranked(usable, keys, F.date_trunc("minute", F.col("at").cast("timestamp")), [F.col("at"), F.col("id")], "_rank")
    step = sequence.shifted(ranks, keys, ["x"], -1, "_before", "_rank")
    spread = F.coalesce(F.percentile_approx(F.abs(F.col("x") - F.col("x_before")), 0.5, 10_000), F.lit(0.0))
    whole = step.groupBy(*keys).agg(F.count("*").alias("_n"), spread.alias("_spread"))
    penalty = F.greatest(F.lit(0.5), 4 * F.col("_spread") ** 2 * F.log(F.greatest(F.col("_n"), F.lit(2))))
    whole = whole.select(*[F.col(k).alias(f"_{k}") for k in keys], "_n", penalty.alias("_penalty"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    known = ranks.join(whole, on).drop(*[f"_{k}" for k in keys])
    first = known.withColumn("_block", F.floor(F.col("_rank") / run))
    second = known.where(F.col("_n") > run).withColumn("_block", -1 - F.floor((F.col("_rank") + run // 2) / run))

    def segment(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank")
        return pdf.iloc[pelt(pdf["x"].to_numpy(), float(pdf["_penalty"].iloc[0]))][["source", "kind", "_rank"]]

    cuts = first.unionByName(second).groupBy(*keys, "_block").applyInPandas(segment, "source string, kind string, _rank long").distinct()
    cuts = cuts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_rank").alias("_cut"))
    marked = known.join(cuts, [*on, F.col("_rank") == F.col("_cut")], "left").drop(*[f"_{k}" for k in keys])
    pieces = sequence.running(marked, keys, "_piece", F.col("_cut").isNotNull().cast("long"), "_rank")
    edge = F.min_by(F.struct("at", "id"), "_rank")
    pieces = pieces.groupBy(*keys, "_piece", "_penalty").agg(edge.alias("e"), F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))

    def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_piece").reset_index(drop=True)
        n, s = pdf["n"].to_numpy(dtype=float), pdf["s"].to_numpy()
        cuts = [0, *_cuts(n, s, pdf["q"].to_numpy(), float(pdf["_penalty"].iloc[0])), len(pdf)]
        out = []
        for a, b, c in zip(cuts, cuts[1:], cuts[2:], strict=False):
            f = known_factor(float(s[b:c].sum() / n[b:c].sum() - s[a:b].sum() / n[a:b].sum()))
            if f is not None:
                out.append((*pdf.loc[b, ["source", "kind", "at", "id"]], 1 / f))
        return pd.DataFrame(out, columns=["source", "kind", "at", "id", "factor"])

    return pieces.select(*keys, "_piece", "_penalty", "e.at", "e.id", "n", "s", "q").groupBy(*keys).applyInPandas(weigh, "source string, kind string, at timestamp_ntz, id string, factor double")


def reversed_values(rows: DataFrame, shifts: DataFrame) -> DataFrame:
    """``rows`` with ``reversed``: each value in the unit with which its history begins. A shift holds from its row on."""
    keys = ["source", "kind"]
    ranks = sequence.ranked(rows.where("at is not null"), keys, F.date_trunc("minute", F.col("at").cast("timestamp")), [F.col("at"), F.col("id")], "_rank")
    marks = shifts.select(*keys, "at", "id", F.log10("factor").alias("_f"))
    # of rows alike in time and id the first one takes the factor, so that it counts once
    again = F.row_number().over(Window.partitionBy(*keys, "at", "id").orderBy("_rank"))
    marked = ranks.withColumn("_again", again).join(marks, [*keys, "at", "id"], "left")
    summed = sequence.running(marked, keys, "_sum", F.when(F.col("_again") == 1, F.coalesce("_f", F.lit(0.0))).otherwise(0.0), "_rank")
    return summed.withColumn("reversed", F.col("value") * F.pow(F.lit(10.0), F.col("_sum"))).drop("_rank", "_again", "_f", "_sum")
