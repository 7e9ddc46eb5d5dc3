"""Exact quantiles by distributed selection: value ranges are narrowed by counting until each rank is met.

A round counts rows per range (``WAYS`` equal parts of what is left, per group and rank) in one group-by, so a task sends at
most ranks x WAYS counts, and the driver sees as many. The next range is from the least to the largest value of the part with the rank;
a bigint is found after seven rounds at most, and no task sorts or holds the distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WAYS = 1024


def _literal(x) -> str:
    return f"{x!r}D" if isinstance(x, float) else f"{x}L"


def _counts(rows: DataFrame, spans: list[tuple]) -> dict[tuple, list[tuple]]:
    """For each span (group, low, high): its parts that hold rows of (g, v), in order, as (rows, least, largest)."""
    per_group: dict = {}
    for g, low, high in spans:
        per_group.setdefault(g, []).append((low, high))
    hits = F.lit(None).cast("array<struct<span:int,part:bigint>>")
    for g, ranges in per_group.items():
        parts = []
        for low, high in ranges:
            if isinstance(low, float):
                part = f"cast(least(floor((v - {_literal(low)}) / {_literal(max((high - low) / WAYS, 5e-324))}), {WAYS - 1}) as bigint)"
            else:
                part = f"(v - {low}L) div {-(-(high - low + 1) // WAYS)}L"
            inside = F.expr(f"v between {_literal(low)} and {_literal(high)}")
            parts.append(F.when(inside, F.struct(F.lit(spans.index((g, low, high))).alias("span"), F.expr(part).alias("part"))))
        hits = F.when(F.col("g").eqNullSafe(F.lit(g)), F.filter(F.array(*parts), lambda x: x.isNotNull())).otherwise(hits)
    seen = rows.select("v", F.explode(hits).alias("h")).groupBy("h.span", "h.part").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    out: dict = {s: [] for s in spans}
    for r in sorted(seen, key=lambda r: (r["span"], r["part"])):
        out[spans[r["span"]]].append((r["n"], r["low"], r["high"]))
    return out


def select_ranks(rows: DataFrame, ranks: dict) -> dict:
    """``rows`` (g, v bigint or double, not null), ``ranks`` {group: ranks from 0} -> {(group, rank): value}: the value at each rank in the
    order of v. Groups are few (their ranges are part of the plan)."""
    bounds = {r["g"]: (r["low"], r["high"]) for r in rows.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    left = {(g, k): (*bounds[g], k) for g, ks in ranks.items() for k in ks}  # range, and the rank inside it
    done = {}
    while True:
        for key, (low, high, _) in list(left.items()):
            if low == high:
                done[key] = low
                del left[key]
        if not left:
            return done
        counts = _counts(rows, sorted({(key[0], low, high) for key, (low, high, _) in left.items()}, key=str))
        for key, (low, high, k) in left.items():
            for n, least, largest in counts[key[0], low, high]:
                if k < n:
                    left[key] = (least, largest, k)
                    break
                k -= n


def exact_quantiles(df: DataFrame, value: Column, probs: list[float], group: Column | None = None) -> dict:
    """{group: [quantile at each of ``probs``]} by linear interpolation between neighbouring ranks, as ``percentile`` has it; None for a
    group without values. ``value`` is a bigint (its range under 2^63) or a double; nulls and NaN are left out."""
    rows = df.select((F.lit(0) if group is None else group).alias("g"), value.alias("v")).where("v is not null and not isnan(v)")
    if rows.schema["v"].dataType.typeName() not in ("double", "long"):
        raise ValueError("quantiles are of bigint or double values")
    sizes = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    at = {g: [p * (n - 1) for p in probs] for g, n in sizes.items()}
    found = select_ranks(rows, {g: sorted({k for x in xs for k in (math.floor(x), math.ceil(x))}) for g, xs in at.items()})
    return {g: [found[g, math.floor(x)] + (x - math.floor(x)) * (found[g, math.ceil(x)] - found[g, math.floor(x)]) for x in xs] for g, xs in at.items()}
