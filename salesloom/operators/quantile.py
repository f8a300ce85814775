"""Exact quantiles of columns too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Zone(NamedTuple):
    """The values strictly between two others (None: no bound): how many lie below it, and in it."""

    low: Any
    high: Any
    below: int
    size: int

    def holds(self, v: Column) -> Column:
        inside = v.isNotNull()
        if self.low is not None:
            inside = inside & (v > F.lit(self.low))
        if self.high is not None:
            inside = inside & (v < F.lit(self.high))
        return inside


def _ends(share: float, margin: float) -> list[float]:
    return [max(share - margin, 0.0), min(share + margin, 1.0)]


def _look(zone: Zone, cut: tuple[Any, Any] | None, ranks: Sequence[int], collect: bool) -> Column:
    """Of a zone the exact number of values below, at, between and at the two values that cut it, and the values
    of the given ranks, if they lie between the cuts and those values may be collected."""
    v = F.col("v")
    inside = zone.holds(v)
    if cut is None:
        counts, middle = [F.lit(0)] * 4, inside
    else:
        first, last = F.lit(cut[0]), F.lit(cut[1])
        middle = inside & (v > first) & (v < last)
        at_last = inside & (v == last) & (v != first)
        counts = [F.count_if(c) for c in (inside & (v < first), inside & (v == first), middle, at_last)]
    picked = F.lit(None)
    if collect:
        ordered = F.sort_array(F.collect_list(F.when(middle, v)))
        start = zone.below + counts[0] + counts[1]
        picked = F.array(*[F.get(ordered, (F.lit(rank) - start).cast("int")) for rank in ranks])
    return F.struct(F.array(*[c.cast("bigint") for c in counts]).alias("counts"), picked.alias("picked"))


def _values_at(values: DataFrame, ranks: dict[int, Zone], cuts: dict[int, tuple[Any, Any]], accuracy: int, at_once: int) -> dict[int, Any]:
    """The values of the given ranks, by narrowing the zone of each until it is found or few values are left."""
    found: dict[int, Any] = {}
    while ranks:
        groups: dict[tuple[Zone, tuple[Any, Any] | None], list[int]] = {}
        for rank, zone in ranks.items():
            groups.setdefault((zone, cuts[rank] if zone.size > at_once else None), []).append(rank)
        # The sketch's error is bounded, and with it what lies between two cuts.
        few = [cut is None or 10 * zone.size <= at_once * accuracy for zone, cut in groups]
        looks = [_look(zone, cut, asked, c).alias(f"g{i}") for i, (((zone, cut), asked), c) in enumerate(zip(groups.items(), few))]
        seen = values.agg(*looks).first()
        ranks = {}
        for i, ((zone, cut), asked) in enumerate(groups.items()):
            below, at_first, between, at_last = seen[f"g{i}"]["counts"]
            for j, rank in enumerate(asked):
                place = rank - zone.below
                if cut is None:
                    found[rank] = seen[f"g{i}"]["picked"][j]
                elif place < below:
                    ranks[rank] = Zone(zone.low, cut[0], zone.below, below)
                elif place < below + at_first:
                    found[rank] = cut[0]
                elif place < below + at_first + between:
                    if few[i]:
                        found[rank] = seen[f"g{i}"]["picked"][j]
                    else:
                        ranks[rank] = Zone(cut[0], cut[1], zone.below + below + at_first, between)
                elif place < below + at_first + between + at_last:
                    found[rank] = cut[1]
                else:
                    passed = below + at_first + between + at_last
                    ranks[rank] = Zone(cut[1], zone.high, zone.below + passed, zone.size - passed)
        wide = {rank: zone for rank, zone in ranks.items() if zone.size > at_once}
        if wide:
            sketches = [
                F.percentile_approx(F.when(z.holds(F.col("v")), F.col("v")), _ends((r - z.below) / z.size, 4 / accuracy), accuracy).alias(f"r{r}")
                for r, z in wide.items()
            ]
            sketched = values.agg(*sketches).first()
            cuts = {rank: tuple(sketched[f"r{rank}"]) for rank in wide}
    return found


def exact_quantiles(
    df: DataFrame, column: str, levels: Sequence[float], accuracy: int = 100_000, at_once: int = 100_000
) -> DataFrame:
    """A row (level, quantile) per level: the linearly interpolated quantile of the non-NULL values.

    Runs when it is called; the driver sees a few numbers per level and round. A mergeable sketch names two
    values around each wanted rank; the next pass counts exactly what lies below, at and between
    them. A rank that is one of the two, or between them, is found in that pass, as at most about 10/accuracy of
    the rows lie there; only if these are more than `at_once` is the part that holds the rank cut again. Parts are
    chosen by count, so that outliers do not matter, a hot value ends a part instead of filling it, and a
    sketch that missed costs rounds, never the result. No task holds more than `at_once` values, whereas the
    built-in exact percentile carries every distinct value to a single one.
    """
    if not all(0 <= q <= 1 for q in levels):
        raise ValueError("q must lie between 0 and 1")
    values = df.select(F.col(column).alias("v")).filter("v IS NOT NULL")
    ends = [e for q in levels for e in _ends(q, 4 / accuracy)]
    n, sketched = values.agg(F.count("v"), F.percentile_approx("v", ends, accuracy)).first()
    wanted: dict[int, tuple[Any, Any]] = {}
    for i, q in enumerate(levels):
        lower = int((n - 1) * q)
        for rank in (lower, min(lower + 1, n - 1)) if n else ():
            wanted.setdefault(rank, (sketched[2 * i], sketched[2 * i + 1]))
    whole = Zone(None, None, 0, n)
    found = _values_at(values, {rank: whole for rank in wanted}, wanted, accuracy, at_once)

    def quantile(q: float) -> float | None:
        if not n:
            return None
        position = (n - 1) * q
        lower = int(position)
        low, high = float(found[lower]), float(found[min(lower + 1, n - 1)])
        return low if low == high or position == lower else low + (high - low) * (position - lower)

    return df.sparkSession.createDataFrame([(float(q), quantile(q)) for q in levels], "level double, quantile double")


def exact_quantile(df: DataFrame, column: str, q: float, accuracy: int = 100_000, at_once: int = 100_000) -> DataFrame:
    """One row, one column `quantile`; see `exact_quantiles`."""
    return exact_quantiles(df, column, [q], accuracy, at_once).select("quantile")


def approximate_quantile(df: DataFrame, column: str, q: float, accuracy: int = 10_000) -> DataFrame:
    """One pass, no second read; the rank is off by at most 1/accuracy of the rows."""
    return df.agg(F.percentile_approx(column, q, accuracy).cast("double").alias("quantile"))
