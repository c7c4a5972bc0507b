"""Counts, cross-tables, percentiles, flags and series as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import crosstab, distribution, flags, frequency, ranking, series
from ..plans import media, orgunits
from .registry import query, rounded


@query(
    "value_counts_share",
    """SELECT event_type, count(*) AS n,
    round(count(*) * 100 / (SELECT count(*) FROM events), 6) AS pct
    FROM events GROUP BY event_type""",
)
def _(t):
    return rounded(frequency.value_shares(t.events, "event_type"), "pct")


@query(
    "topk_with_other",
    """WITH counts AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_name) AS place FROM counts)
    SELECT CASE WHEN place <= 7 THEN p_name ELSE 'Other' END AS label,
    CAST(sum(n) AS BIGINT) AS n, count(*) AS n_values FROM ranked GROUP BY 1""",
)
def _(t):
    return frequency.top_with_other(t.part, "p_name", 7)


@query(
    "topk_groups",
    """SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1
    ORDER BY n DESC, o_custkey LIMIT 10""",
)
def _(t):
    return frequency.most_common(t.orders, "o_custkey", 10)


@query(
    "nlargest",
    """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 15""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return ranking.first_rows(df, [F.desc("o_totalprice"), F.asc("o_orderkey")], 15)


@query("sample_head", "SELECT * FROM part ORDER BY p_partkey LIMIT 10")
def _(t):
    return ranking.first_rows(t.part, [F.asc("p_partkey")], 10)


@query(
    "group_nunique_intensity",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_units,
    round(count(*) / count(DISTINCT user_id), 6) AS intensity FROM events GROUP BY 1""",
)
def _(t):
    return rounded(frequency.use_by_group(t.events, "event_type", "user_id"), "intensity")


@query(
    "distinct_totals",
    """SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_parts,
    count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_orderkey) AS n_orders
    FROM lineitem""",
)
def _(t):
    return frequency.distinct_totals(
        t.lineitem, n_parts="l_partkey", n_suppliers="l_suppkey", n_orders="l_orderkey"
    )


@query(
    "group_mean_units",
    """SELECT type, count(*) AS n,
    round(avg(CASE WHEN duration > 0 THEN duration END) / 60, 4) AS mean_minutes,
    round(avg(revision_size) / 1048576, 4) AS mean_mb FROM {media} GROUP BY type""",
)
def _(t):
    return rounded(media.by_type(t.media), "mean_minutes", "mean_mb", places=4)


@query(
    "threshold_counts",
    """SELECT count(*) FILTER (WHERE duration > 45 * 60) AS n_long,
    round(max(duration) / 60, 6) AS max_minutes,
    count(*) FILTER (WHERE revision_size / 1073741824 > 0.05) AS n_large,
    round(max(revision_size) / 1073741824, 6) AS max_gb FROM {media}""",
)
def _(t):
    found = media.extremes(t.media, long_minutes=45, large_gb=0.05)
    return rounded(found, "max_minutes", "max_gb")


@query(
    "boolean_share_long",
    """WITH f AS (SELECT quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'Quality' AS requirement, 'Required' AS status,
        count(*) FILTER (WHERE quality = 1) AS n,
        round(count(*) FILTER (WHERE quality = 1) * 100 / count(*), 6) AS pct FROM f
    UNION ALL SELECT 'Quality', 'Not Required', count(*) FILTER (WHERE quality IS DISTINCT FROM 1),
        round(count(*) FILTER (WHERE quality IS DISTINCT FROM 1) * 100 / count(*), 6) FROM f
    UNION ALL SELECT 'Toxic', 'Required', count(*) FILTER (WHERE toxic = 1),
        round(count(*) FILTER (WHERE toxic = 1) * 100 / count(*), 6) FROM f
    UNION ALL SELECT 'Toxic', 'Not Required', count(*) FILTER (WHERE toxic IS DISTINCT FROM 1),
        round(count(*) FILTER (WHERE toxic IS DISTINCT FROM 1) * 100 / count(*), 6) FROM f""",
)
def _(t):
    judged = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    wanted = {"Quality": F.col("quality") == 1, "Toxic": F.col("toxic") == 1}
    return rounded(frequency.status_long(judged, wanted), "pct")


@query(
    "compliance_by_group",
    """WITH f AS (SELECT lang, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT coalesce(lang, '(all)') AS lang, count(*) AS total,
    count(*) FILTER (WHERE toxic = 1) AS n_need,
    round(count(*) FILTER (WHERE toxic = 1) * 100 / count(*), 6) AS pct_need
    FROM f GROUP BY GROUPING SETS ((lang), ())""",
)
def _(t):
    judged = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rounded(frequency.need_by_group(judged, "lang", F.col("toxic") == 1), "pct_need")


_PER_ORDER = """per_key AS (SELECT l_orderkey, count(l_partkey) AS item_count
    FROM lineitem GROUP BY 1)"""


@query(
    "count_of_counts",
    f"WITH {_PER_ORDER} SELECT item_count, count(*) AS n_keys FROM per_key GROUP BY 1",
)
def _(t):
    return frequency.count_of_counts(
        frequency.items_per_key(t.lineitem, "l_orderkey", "l_partkey")
    )


@query(
    "complexity_metrics",
    f"""WITH {_PER_ORDER} SELECT count(*) AS n_keys,
    count(*) FILTER (WHERE item_count = 1) AS n_single,
    count(*) FILTER (WHERE item_count > 1) AS n_multiple,
    count(*) FILTER (WHERE item_count >= 3) AS n_three_plus,
    round(count(*) FILTER (WHERE item_count = 1) * 100 / count(*), 6) AS pct_single,
    round(count(*) FILTER (WHERE item_count > 1) * 100 / count(*), 6) AS pct_multiple,
    round(avg(item_count), 6) AS mean_items, max(item_count) AS max_items FROM per_key""",
)
def _(t):
    per_order = frequency.items_per_key(t.lineitem, "l_orderkey", "l_partkey")
    return rounded(frequency.complexity(per_order), "pct_single", "pct_multiple", "mean_items")


@query(
    "first_per_group",
    """SELECT l_orderkey, count(l_partkey) AS item_count, min(l_suppkey) AS l_suppkey
    FROM lineitem GROUP BY 1""",
)
def _(t):
    return frequency.items_per_key(
        t.lineitem, "l_orderkey", "l_partkey", carried="l_suppkey"
    )


@query(
    "positive_negative_split",
    """SELECT count(*) FILTER (WHERE toxic IS DISTINCT FROM 1) AS n_positive,
    count(*) FILTER (WHERE toxic = 1) AS n_negative FROM labels""",
)
def _(t):
    return frequency.split_by_flag(t.labels, F.col("toxic") == 1)


@query(
    "weighted_mean",
    """SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 8)
    AS weighted_mean FROM lineitem GROUP BY 1""",
)
def _(t):
    found = frequency.weighted_mean(
        t.lineitem, "l_discount", "l_quantity", by=["l_returnflag"]
    )
    return rounded(found, "weighted_mean", places=8)


@query(
    "rare_category_removal",
    """SELECT p_partkey, ptype FROM {rare_part} WHERE ptype IS NULL OR ptype NOT IN
    (SELECT ptype FROM {rare_part} WHERE ptype IS NOT NULL GROUP BY 1 HAVING count(*) = 1)""",
)
def _(t):
    return frequency.drop_rare(t.rare_part, "ptype")


# ------------------------------------------------------------------ cross-tables

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_TERM_SQL = """CAST(year(o_orderdate) AS VARCHAR) || ' ' ||
    CASE WHEN month(o_orderdate) <= 4 THEN 'Winter' WHEN month(o_orderdate) <= 8
    THEN 'Summer' ELSE 'Fall' END"""


@query(
    "pivot_row_percent",
    f"""SELECT {_TERM_SQL} AS year_term,
    {', '.join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS n_{i}"
               for i, p in enumerate(_PRIORITIES))},
    {', '.join(f"round(count(*) FILTER (WHERE o_orderpriority = '{p}') * 100 / count(*), 6)"
               f" AS pct_{i}" for i, p in enumerate(_PRIORITIES))}
    , count(*) FILTER (WHERE o_orderpriority NOT IN {_PRIORITIES}) AS n_other
    FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""",
)
def _(t):
    rows = t.orders.select(
        dates.year_term(F.col("o_orderdate")).alias("year_term"), "o_orderpriority"
    )
    table = crosstab.pivot_row_percent(rows, "year_term", "o_orderpriority", _PRIORITIES)
    return rounded(table, *[f"pct_{i}" for i in range(len(_PRIORITIES))])


@query(
    "group_min_order",
    f"""SELECT {_TERM_SQL} AS year_term, min(o_orderdate) AS first_seen FROM orders
    GROUP BY 1 ORDER BY 2""",
)
def _(t):
    rows = t.orders.select(
        dates.year_term(F.col("o_orderdate")).alias("year_term"), "o_orderdate"
    )
    return crosstab.bucket_order(rows, "year_term", "o_orderdate").orderBy("first_seen")


@query(
    "custom_order",
    """SELECT event_type, n, CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1
    WHEN 'error' THEN 2 ELSE 3 END AS INTEGER) AS position FROM
    (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ORDER BY 3""",
)
def _(t):
    counts = frequency.value_counts(t.events, "event_type")
    order = ["view", "click", "error"]
    return crosstab.in_given_order(counts, "event_type", order).orderBy("position")


def _active_sql(group: str, source: str) -> str:
    return f"""SELECT {group} AS group_value,
        count(*) FILTER (WHERE active) AS n_active,
        count(*) FILTER (WHERE NOT active) AS n_inactive, count(*) AS total,
        round(count(*) FILTER (WHERE active) * 100 / count(*), 6) AS pct_active
        FROM (SELECT *, o_orderstatus = 'F' AS active FROM {source}) GROUP BY 1"""


@query("crosstab_pct", _active_sql("o_orderpriority", "orders"))
def _(t):
    rows = t.orders.withColumn("active", F.col("o_orderstatus") == "F")
    found = crosstab.active_by_group(rows, "o_orderpriority", "active")
    return rounded(found, "pct_active")


@query("crosstab_by_year", _active_sql("CAST(year(o_orderdate) AS INTEGER)", "orders"))
def _(t):
    rows = t.orders.withColumn("active", F.col("o_orderstatus") == "F")
    found = crosstab.active_by_group(rows, F.year("o_orderdate"), "active")
    return rounded(found, "pct_active")


@query(
    "period_linkage",
    """WITH p(period, a, b) AS (VALUES ('1995-1996', 1995, 1996), ('1997-1998', 1997, 1998),
        ('1999-2000', 1999, 2000), ('2020-2021', 2020, 2021))
    SELECT period, count(grade_key) AS linked, count(o_orderkey) - count(grade_key)
        AS not_linked, count(o_orderkey) AS total,
        round(coalesce(count(grade_key) * 100 / nullif(count(o_orderkey), 0), 0), 6)
        AS linked_pct
    FROM p LEFT JOIN {linked_orders} o ON year(o_orderdate) BETWEEN a AND b GROUP BY 1""",
)
def _(t):
    periods = ((1995, 1996), (1997, 1998), (1999, 2000), (2020, 2021))
    found = crosstab.linked_by_period(
        t.linked_orders,
        dates.year_period(F.year("o_orderdate"), periods),
        F.col("grade_key").isNotNull(),
        dates.period_names(periods),
    )
    return rounded(found, "linked_pct")


@query(
    "global_ratios",
    """WITH c AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS a,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS b,
    count(*) FILTER (WHERE o_orderstatus = 'none') AS z FROM orders)
    SELECT a AS n_courses, b AS n_sections, z AS n_groups,
    round(b / a, 6) AS sections_per_course, round(z / a, 6) AS groups_per_course,
    round(z / b, 6) AS groups_per_section, b - a AS sections_minus_courses FROM c""",
)
def _(t):
    found = orgunits.ratios(t.orders, kind="o_orderstatus", kinds=("O", "F", "none"))
    return rounded(
        found, "sections_per_course", "groups_per_course", "groups_per_section"
    )


# ------------------------------------------------------------------ distributions


@query(
    "percentile_p99",
    """SELECT round(quantile_cont(l_extendedprice, 0.01), 4) AS p0,
    round(quantile_cont(l_extendedprice, 0.5), 4) AS p1,
    round(quantile_cont(l_extendedprice, 0.99), 4) AS p2 FROM lineitem""",
)
def _(t):
    found = distribution.percentiles(t.lineitem, "l_extendedprice", [0.01, 0.5, 0.99])
    return rounded(found, "p0", "p1", "p2", places=4)


@query(
    "percentile_approx",
    """SELECT count(l_extendedprice) AS n, true AS within_p0, true AS within_p1 FROM lineitem""",
)
def _(t):
    """How many values lie below each figure differs from its rank by the sketch's error
    (one in 20,000 rows) and the rows equal to it at most."""
    found = distribution.percentiles(
        t.lineitem, "l_extendedprice", [0.01, 0.99], approximate=True
    )
    limits = [found.select(p).scalar() for p in ("p0", "p1")]
    value, counts = F.col("l_extendedprice"), [F.count("l_extendedprice").alias("n")]
    for i, limit in enumerate(limits):
        counts += [F.count_if(value < limit).alias(f"below{i}"), F.count_if(value <= limit).alias(f"upto{i}")]
    row = t.lineitem.agg(*counts)
    error = F.col("n") / 10_000 + 1
    within = [
        ((F.col(f"below{i}") - error <= q * F.col("n")) & (F.col(f"upto{i}") + error >= q * F.col("n"))).alias(f"within_p{i}")
        for i, q in enumerate((0.01, 0.99))
    ]
    return row.select("n", *within)


@query(
    "group_median",
    """SELECT l_partkey, round(quantile_cont(l_extendedprice, 0.5), 4) AS p0
    FROM lineitem GROUP BY 1""",
)
def _(t):
    found = distribution.percentiles(t.lineitem, "l_extendedprice", [0.5], by=["l_partkey"])
    return rounded(found, "p0", places=4)


@query(
    "histogram_equal_width",
    """WITH e AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
    w AS (SELECT lo, (hi - lo) / 30 AS width FROM e),
    counts AS (SELECT least(CAST(floor((c_acctbal - lo) / width) AS INTEGER), 29) AS bin,
        count(*) AS n FROM customer, w GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + width * i, 6) AS low,
    round(lo + width * (i + 1), 6) AS high, coalesce(n, 0) AS n
    FROM range(30) r(i) CROSS JOIN w LEFT JOIN counts ON counts.bin = i""",
)
def _(t):
    return rounded(distribution.histogram(t.customer, "c_acctbal", 30), "low", "high")


_RATE_SQL = """rates AS (SELECT *, duration / 60 AS duration_min,
    (revision_size * 8 / duration) / 1e6 AS bitrate_mbps FROM {media}
    WHERE duration > 0 AND revision_size > 0)"""


@query(
    "boxplot_by_group",
    f"""WITH {_RATE_SQL},
    q AS (SELECT source, quantile_cont(bitrate_mbps, 0.25) AS q1,
        quantile_cont(bitrate_mbps, 0.5) AS median,
        quantile_cont(bitrate_mbps, 0.75) AS q3 FROM rates GROUP BY 1)
    SELECT source, count(*) AS n, round(any_value(q1), 6) AS q1,
    round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
    round(min(bitrate_mbps) FILTER (WHERE bitrate_mbps >= q1 - 1.5 * (q3 - q1)
        AND bitrate_mbps <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
    round(max(bitrate_mbps) FILTER (WHERE bitrate_mbps >= q1 - 1.5 * (q3 - q1)
        AND bitrate_mbps <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
    count(*) FILTER (WHERE bitrate_mbps < q1 - 1.5 * (q3 - q1)
        OR bitrate_mbps > q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM rates JOIN q USING (source) GROUP BY 1""",
)
def _(t):
    items = distribution.timed_media(t.media, "duration", "revision_size")
    found = distribution.box_plot(items, "bitrate_mbps", "source")
    return rounded(found, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "outlier_partition",
    """WITH timed AS (SELECT * FROM {media} WHERE duration > 0 AND revision_size > 0),
    lim AS (SELECT quantile_cont(duration, 0.9) AS d, quantile_cont(revision_size, 0.9) AS s
        FROM timed)
    SELECT type, CASE WHEN duration <= d AND revision_size <= s THEN 'central'
        ELSE 'outlier' END AS region, count(*) AS n FROM timed, lim GROUP BY 1, 2""",
)
def _(t):
    return media.size_duration_regions(t.media, prob=0.9)


@query(
    "rate_and_low_tail",
    f"""WITH {_RATE_SQL}, lim AS (SELECT quantile_cont(bitrate_mbps, 0.01) AS lo,
        quantile_cont(bitrate_mbps, 0.99) AS hi FROM rates)
    SELECT count(*) AS n_rows, round(any_value(lo), 6) AS low_limit,
    round(any_value(hi), 6) AS high_limit,
    count(*) FILTER (WHERE bitrate_mbps < lo) AS n_very_low,
    count(*) FILTER (WHERE bitrate_mbps > hi) AS n_very_high,
    count(*) FILTER (WHERE bitrate_mbps < lo AND duration_min >= 10) AS n_long_low,
    round(quantile_cont(duration_min, 0.5) FILTER (WHERE bitrate_mbps < lo
        AND duration_min >= 10), 6) AS median_minutes,
    round(quantile_cont(bitrate_mbps, 0.5) FILTER (WHERE bitrate_mbps < lo
        AND duration_min >= 10), 6) AS median_bitrate FROM rates, lim""",
)
def _(t):
    return rounded(
        media.bitrate_tails(t.media),
        "low_limit",
        "high_limit",
        "median_minutes",
        "median_bitrate",
    )


# ------------------------------------------------------------------ flags

_FLAGS = ("f_big", "f_dear", "f_promo", "f_long")
_LABELS = {"f_big": "F Big", "f_dear": "F Dear", "f_promo": "F Promo", "f_long": "F Long"}


def _flags_sql(names, where: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS flag, '{_LABELS[f]}' AS feature,
        count(*) FILTER (WHERE {f}) AS n,
        round(count(*) FILTER (WHERE {f}) * 100 / count(*), 6) AS pct
        FROM {{part_flags}} WHERE {where}"""
        for f in names
    )


@query("feature_prevalence", _flags_sql(_FLAGS, "true"))
def _(t):
    return rounded(flags.prevalence(t.part_flags, _FLAGS), "pct")


@query("cooccurrence", _flags_sql(("f_big", "f_dear", "f_long"), "f_promo"))
def _(t):
    return rounded(flags.cooccurrence(t.part_flags, "f_promo", _FLAGS), "pct")


_SUM_SQL = " + ".join(f"CAST({f} AS INTEGER)" for f in _FLAGS)


@query(
    "flags_per_row",
    f"""SELECT CAST({_SUM_SQL} AS INTEGER) AS n_flags, count(*) AS n,
    round(count(*) * 100 / (SELECT count(*) FROM part), 6) AS pct
    FROM {{part_flags}} GROUP BY 1""",
)
def _(t):
    return rounded(flags.flags_per_row(t.part_flags, _FLAGS), "pct")


@query(
    "many_flags",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_SUM_SQL} >= 2) AS n_many,
    round(count(*) FILTER (WHERE {_SUM_SQL} >= 2) * 100 / count(*), 6) AS pct_many
    FROM {{part_flags}}""",
)
def _(t):
    return rounded(flags.many_flags(t.part_flags, _FLAGS, 2), "pct_many")


@query(
    "feature_rate_by_group",
    f"""SELECT p_brand, count(DISTINCT p_partkey) AS n_items, count(*) AS n_rows,
    {', '.join(f'round(avg(CAST({f} AS INTEGER)) * 100, 6) AS pct_{f}' for f in _FLAGS)}
    FROM {{part_flags}} GROUP BY 1 ORDER BY n_items DESC, p_brand LIMIT 15""",
)
def _(t):
    found = flags.rates_by_group(t.part_flags, "p_brand", "p_partkey", _FLAGS, 15)
    return rounded(found, *[f"pct_{f}" for f in _FLAGS])


# ------------------------------------------------------------------ series


@query(
    "year_counts_capped",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
    CASE WHEN year(o_orderdate) <= 1998 THEN 'shown' ELSE 'after' END AS part
    FROM orders GROUP BY 1, 3""",
)
def _(t):
    return series.year_counts(t.orders, "o_orderdate", 1998)


_MONTHS_SQL = """SELECT date_trunc('month', o_orderdate) AS month_start,
    CAST(year(any_value(o_orderdate)) AS INTEGER) AS year,
    CAST(month(any_value(o_orderdate)) AS INTEGER) AS month, count(*) AS n
    FROM orders GROUP BY 1"""


@query(
    "month_series",
    f"""SELECT CAST(month_start AS TIMESTAMP) AS month_start, year, month, n
    FROM ({_MONTHS_SQL})""",
)
def _(t):
    return series.month_counts(t.orders, "o_orderdate")


@query(
    "monthly_tail",
    f"""SELECT CAST(month_start AS TIMESTAMP) AS month_start, year, month, n
    FROM ({_MONTHS_SQL}) ORDER BY 1 DESC LIMIT 12""",
)
def _(t):
    return ranking.last_buckets(
        series.month_counts(t.orders, "o_orderdate"), "month_start", 12
    )


@query(
    "revision_split",
    """SELECT count(*) AS n_events, count(*) FILTER (WHERE l_linenumber = 1) AS n_initial,
    count(*) - count(*) FILTER (WHERE l_linenumber = 1) AS n_subsequent,
    count(l_shipdate) AS n_dated FROM lineitem""",
)
def _(t):
    return series.first_and_later(t.lineitem, "l_linenumber", "l_shipdate")
