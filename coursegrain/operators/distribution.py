"""Percentiles, histograms, box plots and percentile-based partitions.

The built-in exact percentile merges every distinct value of a group in one task. Here a
percentile takes three steps that keep every task small, and the result is exact:

1. A sketch of each measure gives cut points: even shares of the rows, and narrow ranges
   around the wanted shares. They are constants from then on.
2. Rows are counted by range, in the map tasks first. Counts are exact, so the range that
   holds a wanted rank is known for certain, however good the sketch was. The narrow ranges
   keep their values apart in the same pass.
3. Where a wanted range's values are not known yet, its rows alone are counted by value.

Percentiles of groups are left to the built-in aggregate, which combines values in the map
tasks, as long as a group is small. Larger groups are counted by group and range as above,
so that a group that holds most rows is split by range and nothing but counts is shuffled.

Percentiles of the whole table are numbers: they are found when a function is called.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import megabits_per_second, minutes, row_count
from ..functions.names import as_column, col
from .hierarchy import cut_lineage
from .joins import with_small
from .membership import bitmap

# The sketch is off by about 1/ACCURACY of the rows; the narrow ranges around a wanted
# share allow eight times that on either side.
ACCURACY = 20_000
_MARGIN = 8 / ACCURACY
# Even shares of the whole table, and of tables with groups; narrow ranges of a wanted share.
_SHARES, _GROUP_SHARES, _STEPS = 16, 256, 4
# Groups of more rows than this are split.
_LARGE_GROUP = 1_000_000
# Tables of this many rows at most are sent to all tasks.
_FEW = 1_000


def percentiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    *,
    by: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """``by..., p0, p1, ...``: percentiles of the present values, interpolated
    linearly between neighbours. Groups without any value are left out.

    ``approximate`` takes the sketch's own answer, one pass.
    """
    # Groups get short names inside, so that no column name can clash.
    keys = [f"g{i}" for i in range(len(by))]
    names = [f"p{i}" for i in range(len(probs))]
    values = df.select(
        *[col(name).alias(key) for name, key in zip(by, keys)],
        as_column(value).cast("double").alias("m0"),
    )
    if approximate:
        present = values.where(F.col("m0").isNotNull() & ~F.isnan("m0"))
        found = present.groupBy(*keys).agg(
            *[F.percentile_approx("m0", p, ACCURACY).alias(n) for n, p in zip(names, probs)]
        )
    elif by:
        found = _of_groups(values.dropna(subset=keys), probs, keys, names)
    else:
        (points,) = percentile_values(values, {"m0": probs}).values()
        found = df.sparkSession.range(1).select(*[F.lit(x).cast("double").alias(n) for x, n in zip(points, names)])
    return found.toDF(*by, *names)


def _of_groups(values: DataFrame, probs: Sequence[float], keys: list[str], names: list[str]) -> DataFrame:
    present = values.where(F.col("m0").isNotNull() & ~F.isnan("m0"))
    large = present.groupBy(*keys).agg(row_count().alias("n")).where(F.col("n") > _LARGE_GROUP)
    # At most one group for every so many rows.
    large = cut_lineage(large.select(*keys))
    some = not large.isEmpty()
    small = present.join(F.broadcast(large), keys, "left_anti") if some else present
    exact = F.percentile("m0", [float(p) for p in probs])
    found = small.groupBy(*keys).agg(exact.alias("p")).select(
        *keys, *[F.col("p")[i].alias(n) for i, n in enumerate(names)]
    )
    if not some:
        return found
    points = _points(present.join(F.broadcast(large), keys, "left_semi"), {"m0": probs}, keys)
    return found.unionByName(
        points.groupBy(*keys).agg(
            *[F.max(F.when(F.col("i") == i, F.col("value"))).alias(n) for i, n in enumerate(names)]
        )
    )


def percentile_values(
    df: DataFrame, wanted: Mapping[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Exact percentiles of several columns over all rows, as numbers: two passes for all
    of them together, a third where the sketch missed."""
    names = {f"m{k}": name for k, name in enumerate(wanted)}
    values = df.select(*[col(name).cast("double").alias(m) for m, name in names.items()])
    cuts = _cuts(values, {m: wanted[name] for m, name in names.items()}, narrow=True)
    cells = _cells(values, cuts, [])
    counted = cut_lineage(cells.groupBy("m", "range", "at").agg(row_count().alias("n")))
    # A row for each range: some dozens.
    ranges = counted.groupBy("m", "range").agg(F.sum("n").alias("n"), F.bool_or(F.col("at").isNull()).alias("coarse"))
    held: dict[str, list] = {m: [] for m in names}
    for r in ranges.orderBy("m", "range").collect():
        held[r["m"]].append(r)
    ranks = {m: [(sum(r["n"] for r in held[m]) - 1) * float(p) for p in wanted[name]] for m, name in names.items()}
    wants: dict[tuple[str, int], set[int]] = {}
    coarse: set[tuple[str, int]] = set()
    at: dict[tuple[str, int], tuple[str, int, int]] = {}
    for m, own in held.items():
        start = 0
        for r in own:
            for k in {k for rank in ranks[m] for k in (math.floor(rank), math.ceil(rank))}:
                if start <= k < start + r["n"]:
                    wants.setdefault((m, r["range"]), set()).add(k - start)
                    at[m, k] = (m, r["range"], k - start)
                    if r["coarse"]:
                        coarse.add((m, r["range"]))
            start += r["n"]

    def among(places) -> Column:
        return reduce(or_, [(F.col("m") == m) & (F.col("range") == r) for m, r in places], F.lit(False))

    known = counted.where(F.col("at").isNotNull() & among(wants)).withColumnRenamed("at", "v")
    if coarse:
        fetched = cells.where(among(coarse)).groupBy("m", "range", "v").agg(row_count().alias("n"))
        known = known.unionByName(fetched)
    inside = Window.partitionBy("m", "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("upto") - 1
    hit = [
        (F.col("m") == m) & (F.col("range") == r) & F.lit(k).between(F.col("upto") - F.col("n"), last)
        for (m, r), places in wants.items() for k in places
    ]
    found = known.withColumn("upto", F.sum("n").over(inside)).where(reduce(or_, hit, F.lit(False))).collect()
    value = {
        (m, r, k): row["v"] for (m, r), places in wants.items() for k in places for row in found
        if (row["m"], row["range"]) == (m, r) and row["upto"] - row["n"] <= k < row["upto"]
    }
    out: dict[str, list[float | None]] = {}
    for m, name in names.items():
        ends = [(value.get(at.get((m, math.floor(x)))), value.get(at.get((m, math.ceil(x)))), x) for x in ranks[m]]
        out[name] = [None if a is None else a + (b - a) * (x - math.floor(x)) for a, b, x in ends]
    return out


def _cuts(values: DataFrame, wanted: Mapping[str, Sequence[float]], narrow: bool) -> dict[str, list[tuple[float, bool]]]:
    """Rising cut points of each measure, and whether the range from one to the next is
    a narrow one, whose values are few."""
    shares: dict[str, list[tuple[float, bool]]] = {}
    for m, probs in wanted.items():
        many = _SHARES if narrow else _GROUP_SHARES
        marks = {k / many: False for k in range(1, many)}
        for p in probs if narrow else ():
            edges = [p - _MARGIN + 2 * _MARGIN * k / _STEPS for k in range(_STEPS + 1)]
            marks = {q: n for q, n in marks.items() if not edges[0] <= q <= edges[-1]}
            marks |= {q: k < _STEPS for k, q in enumerate(edges)}
        shares[m] = sorted((q, n) for q, n in marks.items() if q < 1)
    present = {m: F.when(~F.isnan(m), F.col(m)) for m in wanted}
    # A share below 0 stands for the least value.
    sketches = [
        F.percentile_approx(present[m], [max(q, 0.0) for q, _ in marks], ACCURACY).alias(m)
        for m, marks in shares.items()
    ]
    found = values.agg(*sketches).first()
    cuts: dict[str, list[tuple[float, bool]]] = {}
    for m, marks in shares.items():
        own: dict[float, bool] = {}
        for value, (_, few) in zip(found[m] or [], marks):
            own[value] = few
        cuts[m] = sorted(own.items())
    return cuts


def _range_of(value: Column, cuts: Sequence[float], low: int = 0) -> Column:
    """How many cut points are at or below a value, by halving."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    return F.when(value < cuts[middle], _range_of(value, cuts[:middle], low)).otherwise(
        _range_of(value, cuts[middle + 1 :], low + middle + 1)
    )


def _cells(values: DataFrame, cuts: Mapping[str, list[tuple[float, bool]]], by: list[str]) -> DataFrame:
    """``by..., m, range, at, v``: each present value with its range; ``at`` is the value
    again in narrow ranges."""

    def cell(m: str) -> Column:
        place = _range_of(F.col(m), [c for c, _ in cuts[m]])
        few = [k + 1 for k, (_, few) in enumerate(cuts[m]) if few]
        own = F.when(place.isin(few), F.col(m)) if few else F.lit(None).cast("double")
        return F.struct(F.lit(m).alias("m"), place.alias("range"), own.alias("at"), F.col(m).alias("v"))

    return (
        values.select(*by, F.explode(F.array(*map(cell, cuts))).alias("c"))
        .select(*by, "c.*")
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    )


def _points(values: DataFrame, wanted: Mapping[str, Sequence[float]], by: list[str]) -> DataFrame:
    """``by..., m, i, value``: percentile i of measure m in large groups."""
    cuts = _cuts(values, wanted, narrow=False)
    cells = _cells(values, cuts, by)
    key = [*by, "m"]
    counted = cut_lineage(cells.groupBy(*key, "range", "at").agg(row_count().alias("n")))
    per_range = counted.groupBy(*key, "range").agg(F.sum("n").alias("held"), F.bool_or(F.col("at").isNull()).alias("coarse"))
    upto = F.sum("held").over(Window.partitionBy(*key).orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("held").over(Window.partitionBy(*key))
    shares = F.create_map(
        *[x for m, probs in wanted.items() for x in (F.lit(m), F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)
        ]))]
    )
    rank = (F.col("total") - 1) * F.col("s.p")
    ranges = cut_lineage(
        per_range.withColumns({"start": upto - F.col("held"), "total": total})
        .withColumn("s", F.explode(shares[F.col("m")]))
        .select(*key, "range", "start", "held", "coarse", F.col("s.i").alias("i"), rank.alias("rank"))
        .where((F.col("start") <= F.ceil("rank")) & (F.floor("rank") < F.col("start") + F.col("held")))
    )
    known = counted.where("at IS NOT NULL").withColumnRenamed("at", "v")
    missed = ranges.where("coarse").select(*key, "range").distinct()
    if not missed.isEmpty():
        known = known.unionByName(_counted_values(cells, cut_lineage(missed), key))
    inside = Window.partitionBy(*key, "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    # Few of the narrow ranges hold a rank: the others go before they are sorted.
    held = known.join(ranges.select(*key, "range").distinct(), [*key, "range"], "left_semi")
    ranked = held.withColumn("upto", F.sum("n").over(inside)).join(ranges, [*key, "range"])
    first, last = F.col("start") + F.col("upto") - F.col("n"), F.col("start") + F.col("upto") - 1

    def value_at(place: Column) -> Column:
        return F.max(F.when(place.between(first, last), F.col("v")))

    ends = ranked.groupBy(*key, "i").agg(
        value_at(F.floor("rank")).alias("a"),
        value_at(F.ceil("rank")).alias("b"),
        F.max(F.col("rank") - F.floor("rank")).alias("part"),
    )
    return ends.select(*key, "i", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("value"))


def _counted_values(cells: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """The values in ``ranges``, counted. Rows of other ranges are dropped where they are
    read: by the ranges themselves if these are few, else by a bitmap of them."""
    named = [*key, "range"]
    if ranges.count() <= _FEW:
        return cells.join(F.broadcast(ranges), named, "left_semi").groupBy(*named, "v").agg(row_count().alias("n"))
    mark = F.xxhash64(*named)
    some = cells.where(bitmap(ranges.select(mark.alias("mark")), "mark").might_hold(mark))
    counted = some.groupBy(*named, "v").agg(row_count().alias("n"))
    return counted.join(ranges, named, "left_semi")


def percentile_value(
    df: DataFrame, value: str | Column, prob: float, *, approximate: bool = False
) -> Column:
    """One percentile of the frame as a constant for other expressions."""
    if approximate:
        return percentiles(df, value, [prob], approximate=True).scalar()
    found = percentile_values(df.select(as_column(value).alias("value")), {"value": [prob]})
    return F.lit(found["value"][0]).cast("double")


def histogram(df: DataFrame, value: str | Column, bins: int) -> DataFrame:
    """``bin, low, high, n`` for every one of ``bins`` equal-width bins between
    the least and the greatest value; the last bin holds its upper edge. A
    constant column gets one unit range around it; no values give no rows.

    The edges are read as constants, so each row is binned where it is scanned.
    """
    values = df.select(as_column(value).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    least, most = F.min("v"), F.max("v")
    edges = values.agg(
        F.struct(
            F.when(least < most, least).otherwise(least - 0.5).alias("low"),
            F.when(least < most, most).otherwise(most + 0.5).alias("high"),
        )
    ).scalar()
    # One column holds the edges, so the plan holds the subquery once.
    low = F.col("edges.low")
    width = (F.col("edges.high") - low) / bins
    place = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
    counts = (
        values.withColumn("edges", edges)
        .select(place.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(row_count().alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counts, "bin", "left")
        .withColumn("edges", edges)
        .select(
            "bin",
            (low + width * F.col("bin")).alias("low"),
            (low + width * (F.col("bin") + 1)).alias("high"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
        .where(F.col("low").isNotNull())
    )


def box_plot(
    df: DataFrame, value: str | Column, by: str, *, approximate: bool = False
) -> DataFrame:
    """``by, n, q1, median, q3, whisker_low, whisker_high, n_outliers`` per
    non-NULL group; whiskers are the extreme values within 1.5 quartile ranges."""
    values = df.select(
        col(by).alias("group"), as_column(value).cast("double").alias("v")
    ).where(F.col("group").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    quartiles = cut_lineage(
        percentiles(values, "v", [0.25, 0.5, 0.75], by=["group"], approximate=approximate)
    )
    reach = (F.col("p2") - F.col("p0")) * 1.5
    within = F.col("v").between(F.col("p0") - reach, F.col("p2") + reach)
    return (
        with_small(values, quartiles, "group")
        .groupBy(F.col("group").alias(by))
        .agg(
            row_count().alias("n"),
            F.first("p0").alias("q1"),
            F.first("p1").alias("median"),
            F.first("p2").alias("q3"),
            F.min(F.when(within, F.col("v"))).alias("whisker_low"),
            F.max(F.when(within, F.col("v"))).alias("whisker_high"),
            F.count_if(~within).alias("n_outliers"),
        )
    )


def central_or_outlier(
    df: DataFrame, measures: Sequence[str], prob: float = 0.99, *, approximate: bool = False
) -> DataFrame:
    """Label each row ``central`` when every measure is within its percentile
    over all rows, else ``outlier``. No row is lost and nothing is joined."""
    if approximate:
        limits = [percentile_value(df, name, prob, approximate=True) for name in measures]
    else:
        found = percentile_values(df, {name: [prob] for name in measures})
        limits = [F.lit(found[name][0]) for name in measures]
    inside = F.lit(True)
    for name, limit in zip(measures, limits):
        inside = inside & F.coalesce(col(name) <= limit, F.lit(False))
    return df.withColumn("region", F.when(inside, "central").otherwise("outlier"))


def timed_media(df: DataFrame, seconds: str, size: str) -> DataFrame:
    """Rows with positive duration and size, with ``duration_min`` and
    ``bitrate_mbps``."""
    return df.where((col(seconds) > 0) & (col(size) > 0)).select(
        "*",
        minutes(col(seconds)).alias("duration_min"),
        megabits_per_second(col(size), col(seconds)).alias("bitrate_mbps"),
    )


def bitrate_tails(
    media: DataFrame, *, low: float = 0.01, high: float = 0.99, long_minutes: float = 10
) -> DataFrame:
    """One row on the tails of ``bitrate_mbps``: the two percentiles, rows beyond
    each, and the long rows of the low tail with their medians."""
    low_limit, high_limit = percentile_values(media, {"bitrate_mbps": [low, high]})["bitrate_mbps"]
    limits = [F.lit(x).cast("double") for x in (low_limit, high_limit)]
    rate, long_enough = F.col("bitrate_mbps"), F.col("duration_min") >= long_minutes
    suspect = media.where((rate < limits[0]) & long_enough).select("duration_min", "bitrate_mbps")
    # A share of the rows as small as the tail, read twice below.
    suspect = cut_lineage(suspect)
    medians = percentile_values(suspect, {"duration_min": [0.5], "bitrate_mbps": [0.5]})
    return media.agg(
        row_count().alias("n_rows"),
        limits[0].alias("low_limit"),
        limits[1].alias("high_limit"),
        F.count_if(rate < limits[0]).alias("n_very_low"),
        F.count_if(rate > limits[1]).alias("n_very_high"),
        F.count_if((rate < limits[0]) & long_enough).alias("n_long_low"),
        F.lit(medians["duration_min"][0]).cast("double").alias("median_minutes"),
        F.lit(medians["bitrate_mbps"][0]).cast("double").alias("median_bitrate"),
    )
