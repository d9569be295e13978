"""Exact quantiles without a sorted task: selection by passes over ever narrower ranges."""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct values with their counts that the driver takes at most.
FEW = 10_000
#: The relative error in rank of one pass is 1 / ACCURACY.
ACCURACY = 10_000


def quantile(df: DataFrame, column: str, q: float = 0.5, few: int = FEW, accuracy: int = ACCURACY) -> float | None:
    """The q-quantile of the numbers in a column, interpolated between neighbours; null without any.

    A pass with a mergeable sketch brackets the wanted ranks between two values of the column; the next one counts what
    lies below and inside. The bracket narrows by the sketch's accuracy each time, until its distinct values are few
    enough to be counted one by one.
    """
    rows = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    n = rows.count()
    if not n:
        return None
    rank = (n - 1) * q
    lo = floor(rank)
    hi = min(lo + 1, n - 1)
    below, inside, size = 0, rows, n
    while True:
        counted = inside.groupBy("v").agg(F.count("*").alias("n"))
        if size <= few or counted.limit(few + 1).count() <= few:
            break
        margin = 2.0 / accuracy
        at = [max((lo - below) / size - margin, 0.0), min((hi - below + 1) / size + margin, 1.0)]
        a, b = inside.agg(F.percentile_approx("v", F.array(*map(F.lit, at)), F.lit(accuracy)).alias("p")).first()["p"]
        split = inside.agg(F.count_if(F.col("v") < a).alias("less"), F.count_if(F.col("v").between(a, b)).alias("mid")).first()
        if not (below + split["less"] <= lo and hi < below + split["less"] + split["mid"]) or split["mid"] == size:
            raise ArithmeticError("the sketch missed the bracket")
        below, size = below + split["less"], split["mid"]
        inside = inside.filter(F.col("v").between(a, b))
    found, seen = {}, below
    for r in sorted(counted.collect(), key=lambda r: r["v"]):
        for k in (lo, hi):
            if seen <= k < seen + r["n"]:
                found[k] = r["v"]
        seen += r["n"]
    return float(found[lo]) + (float(found[hi]) - float(found[lo])) * (rank - lo)
