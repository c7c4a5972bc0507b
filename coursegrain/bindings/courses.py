"""The course analyses as queries over course-shaped views of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import assessment, dictionary, media, modifications, orgunits, quizconfig, release
from .registry import query, rounded

# ------------------------------------------------------------------ assessment

_TERM = """CAST(year(creation_date) AS VARCHAR) || ' ' ||
    CASE WHEN month(creation_date) <= 4 THEN 'Winter' WHEN month(creation_date) <= 8
    THEN 'Summer' ELSE 'Fall' END"""
_TOP_NAMES = """top AS (SELECT quiz_name FROM {quizzes} WHERE quiz_name IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, quiz_name LIMIT 10)"""


@query(
    "assessment_common_names",
    """WITH counts AS (SELECT quiz_name, count(*) AS n FROM {quizzes}
        WHERE quiz_name IS NOT NULL GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, quiz_name) AS place FROM counts)
    SELECT CASE WHEN place <= 10 THEN quiz_name ELSE 'Other' END AS label,
    CAST(sum(n) AS BIGINT) AS n, count(*) AS n_values FROM ranked GROUP BY 1""",
)
def _(t):
    return assessment.common_names(t.quizzes)


@query(
    "assessment_names_by_term",
    f"""WITH {_TOP_NAMES}, q AS (SELECT *, {_TERM} AS year_term FROM {{quizzes}}
        WHERE creation_date IS NOT NULL),
    o AS (SELECT year_term, min(creation_date) AS first_seen FROM q GROUP BY 1),
    c AS (SELECT year_term, quiz_name, count(*) AS n FROM q
        WHERE quiz_name IN (SELECT quiz_name FROM top) GROUP BY 1, 2)
    SELECT year_term, first_seen, quiz_name, coalesce(n, 0) AS n, coalesce(
    round(n * 100 / sum(n) OVER (PARTITION BY year_term), 6), 0) AS pct
    FROM o CROSS JOIN top LEFT JOIN c USING (year_term, quiz_name)""",
)
def _(t):
    return rounded(assessment.names_by_term(t.quizzes), "pct")


@query(
    "assessment_names_by_interval",
    f"""WITH {_TOP_NAMES}, q AS (SELECT quiz_name, CASE WHEN creation_date IS NULL
        THEN 'Unknown' WHEN year(creation_date) < 2010 THEN 'Before 2010'
        WHEN year(creation_date) < 2015 THEN '2010-2015'
        WHEN year(creation_date) < 2020 THEN '2015-2020'
        WHEN year(creation_date) < 2025 THEN '2020-2025' ELSE '2025+' END AS "interval"
        FROM {{quizzes}} WHERE quiz_name IN (SELECT quiz_name FROM top)),
    c AS (SELECT "interval", quiz_name, count(*) AS n FROM q GROUP BY 1, 2)
    SELECT "interval", quiz_name, coalesce(n, 0) AS n, coalesce(
    round(n * 100 / sum(n) OVER (PARTITION BY "interval"), 6), 0) AS pct,
    CAST(CASE "interval" WHEN 'Before 2010' THEN 0 WHEN '2010-2015' THEN 1
        WHEN '2015-2020' THEN 2 WHEN '2020-2025' THEN 3 WHEN '2025+' THEN 4 ELSE 5 END
        AS INTEGER) AS position FROM (SELECT DISTINCT "interval" FROM c) CROSS JOIN top
        LEFT JOIN c USING ("interval", quiz_name)""",
)
def _(t):
    return rounded(assessment.names_by_interval(t.quizzes), "pct")


@query(
    "assessment_linked_share",
    """SELECT count(*) AS total, count(grade_object_id) AS linked,
    count(*) - count(grade_object_id) AS not_linked,
    round(count(grade_object_id) * 100 / count(*), 6) AS linked_pct,
    round((count(*) - count(grade_object_id)) * 100 / count(*), 6) AS not_linked_pct
    FROM {quizzes}""",
)
def _(t):
    found = assessment.linked_share(t.quizzes, F.col("grade_object_id").isNotNull())
    return rounded(found, "linked_pct", "not_linked_pct")


@query(
    "assessment_course_linkage",
    """WITH q AS (SELECT org_unit_id, bool_or(grade_object_id IS NOT NULL) AS k
        FROM {quizzes} GROUP BY 1), g AS (SELECT DISTINCT org_unit_id FROM {grades}),
    b AS (SELECT k FROM q JOIN g USING (org_unit_id))
    SELECT (SELECT count(*) FROM q) AS n_left, (SELECT count(*) FROM g) AS n_right,
    count(*) AS n_both, count(*) FILTER (WHERE k) AS n_linked,
    count(*) FILTER (WHERE NOT k) AS n_unlinked,
    round(count(*) FILTER (WHERE NOT k) * 100 / count(*), 6) AS pct_unlinked FROM b""",
)
def _(t):
    return rounded(assessment.course_linkage(t.quizzes, t.grades), "pct_unlinked")


@query(
    "assessment_linkage_by_period",
    """WITH p(period, a, b) AS (VALUES ('2010-2015', 2010, 2015), ('2016-2020', 2016, 2020),
        ('2021-2025', 2021, 2025))
    SELECT period, count(grade_object_id) AS linked,
    count(quiz_id) - count(grade_object_id) AS not_linked, count(quiz_id) AS total,
    round(coalesce(count(grade_object_id) * 100 / nullif(count(quiz_id), 0), 0), 6)
        AS linked_pct
    FROM p LEFT JOIN {quizzes} ON year(creation_date) BETWEEN a AND b GROUP BY 1""",
)
def _(t):
    return rounded(assessment.linkage_by_period(t.quizzes), "linked_pct")


# ------------------------------------------------------------------ release conditions

_PURPOSES = ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''"))
    for k, v in release.CONDITION_PURPOSE.items()
)
_ROLE = f"name = '{release.ROLE_CONDITION}'"


@query(
    "release_type_usage",
    f"""WITH d(name, purpose) AS (VALUES {_PURPOSES})
    SELECT c.name, count(*) AS n,
    round(count(*) * 100 / (SELECT count(*) FROM {{conditions}}), 6) AS pct,
    count(DISTINCT org_unit_id) AS n_units,
    round(count(*) / count(DISTINCT org_unit_id), 6) AS intensity,
    any_value(purpose) AS purpose FROM {{conditions}} c LEFT JOIN d ON c.name = d.name
    WHERE c.name IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
)
def _(t):
    return rounded(release.type_usage(t.conditions), "pct", "intensity")


@query(
    "release_role_totals",
    f"""SELECT count(*) AS n, count(DISTINCT org_unit_id) AS n_units,
    round(count(*) / count(DISTINCT org_unit_id), 6) AS intensity,
    count(*) FILTER (WHERE NOT is_negative_condition) AS n_positive,
    count(*) FILTER (WHERE is_negative_condition) AS n_negative
    FROM {{conditions}} WHERE {_ROLE}""",
)
def _(t):
    return rounded(release.type_totals(t.conditions), "intensity")


@query(
    "release_role_operators",
    f"""SELECT operator_type_desc, count(*) AS n FROM {{conditions}}
    WHERE {_ROLE} AND operator_type_desc IS NOT NULL GROUP BY 1""",
)
def _(t):
    return release.operators_of_type(t.conditions)


@query(
    "release_busiest_units",
    f"""SELECT org_unit_id, count(*) AS n FROM {{conditions}} WHERE {_ROLE}
    GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20""",
)
def _(t):
    return release.busiest_units(t.conditions)


@query(
    "release_unit_histogram",
    f"""WITH u AS (SELECT CAST(count(*) AS DOUBLE) AS v FROM {{conditions}} WHERE {_ROLE}
        GROUP BY org_unit_id),
    w AS (SELECT min(v) AS lo, (max(v) - min(v)) / 30 AS width FROM u),
    counts AS (SELECT least(CAST(floor((v - lo) / width) AS INTEGER), 29) AS bin,
        count(*) AS n FROM u, w GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + width * i, 6) AS low,
    round(lo + width * (i + 1), 6) AS high, coalesce(n, 0) AS n
    FROM range(30) r(i) CROSS JOIN w LEFT JOIN counts ON counts.bin = i""",
)
def _(t):
    return rounded(release.unit_histogram(t.conditions), "low", "high")


@query(
    "release_unit_median",
    f"""SELECT quantile_cont(v, 0.5) AS median FROM (SELECT CAST(count(*) AS DOUBLE) AS v
    FROM {{conditions}} WHERE {_ROLE} GROUP BY org_unit_id)""",
)
def _(t):
    return release.unit_median(t.conditions)


_ITEMS = """items AS (SELECT result_id, count(name) AS item_count,
    min(org_unit_id) AS org_unit_id FROM {conditions} GROUP BY 1)"""


@query(
    "release_item_distribution",
    f"WITH {_ITEMS} SELECT item_count, count(*) AS n_keys FROM items GROUP BY 1",
)
def _(t):
    return release.item_distribution(t.conditions)


@query(
    "release_item_complexity",
    f"""WITH {_ITEMS} SELECT count(*) AS n_keys,
    count(*) FILTER (WHERE item_count = 1) AS n_single,
    count(*) FILTER (WHERE item_count > 1) AS n_multiple,
    count(*) FILTER (WHERE item_count >= 3) AS n_three_plus,
    round(count(*) FILTER (WHERE item_count = 1) * 100 / count(*), 6) AS pct_single,
    round(count(*) FILTER (WHERE item_count > 1) * 100 / count(*), 6) AS pct_multiple,
    round(avg(item_count), 6) AS mean_items, max(item_count) AS max_items FROM items""",
)
def _(t):
    found = release.item_complexity(t.conditions)
    return rounded(found, "pct_single", "pct_multiple", "mean_items")


@query(
    "release_most_complex",
    f"""WITH {_ITEMS} SELECT result_id, item_count, org_unit_id FROM items
    ORDER BY item_count DESC, result_id LIMIT 15""",
)
def _(t):
    return release.most_complex_items(t.conditions)


@query(
    "release_totals",
    """SELECT count(*) AS n_rows, count(DISTINCT name) AS n_types,
    count(DISTINCT org_unit_id) AS n_units, count(DISTINCT result_id) AS n_items
    FROM {conditions}""",
)
def _(t):
    return release.totals(t.conditions)


# ------------------------------------------------------------------ media


@query(
    "media_by_type",
    """SELECT type, count(*) AS n,
    round(avg(CASE WHEN duration > 0 THEN duration END) / 60, 6) AS mean_minutes,
    round(avg(revision_size) / 1048576, 6) AS mean_mb FROM {recordings}
    WHERE type IS NOT NULL GROUP BY 1""",
)
def _(t):
    return rounded(media.by_type(t.recordings), "mean_minutes", "mean_mb")


@query(
    "media_processing",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS requirement, '{status}' AS status,
        count(*) FILTER (WHERE {c}) AS n,
        round(count(*) FILTER (WHERE {c}) * 100 / count(*), 6) AS pct FROM {{recordings}}"""
        for name, flag in (
            ("Transcoding", "required_transcoding"),
            ("Transcription", "required_transcribing"),
        )
        for status, c in (("Required", flag), ("Not Required", f"NOT {flag}"))
    ),
)
def _(t):
    return rounded(media.processing(t.recordings), "pct")


@query(
    "media_transcription_need",
    """SELECT type, count(*) AS total, count(*) FILTER (WHERE required_transcribing)
    AS n_need, round(count(*) FILTER (WHERE required_transcribing) * 100 / count(*), 6)
    AS pct_need FROM {recordings} WHERE type IS NOT NULL GROUP BY 1
    UNION ALL SELECT '(all)', count(*), count(*) FILTER (WHERE required_transcribing),
    round(count(*) FILTER (WHERE required_transcribing) * 100 / count(*), 6)
    FROM {recordings}""",
)
def _(t):
    return rounded(media.transcription_need(t.recordings), "pct_need")


_RATES = """rates AS (SELECT *, duration / 60 AS duration_min,
    (revision_size * 8 / duration) / 1e6 AS bitrate_mbps FROM {recordings}
    WHERE duration > 0 AND revision_size > 0),
    lim AS (SELECT quantile_cont(bitrate_mbps, 0.01) AS lo,
        quantile_cont(bitrate_mbps, 0.99) AS hi, quantile_cont(duration, 0.99) AS d,
        quantile_cont(revision_size, 0.99) AS s FROM rates)"""


@query(
    "media_size_duration_regions",
    f"""WITH {_RATES} SELECT type, CASE WHEN duration <= d AND revision_size <= s
    THEN 'central' ELSE 'outlier' END AS region, count(*) AS n FROM rates, lim
    WHERE type IS NOT NULL GROUP BY 1, 2""",
)
def _(t):
    return media.size_duration_regions(t.recordings)


@query(
    "media_bitrate_histogram",
    f"""WITH {_RATES}, u AS (SELECT bitrate_mbps AS v FROM rates, lim
        WHERE bitrate_mbps BETWEEN lo AND hi),
    w AS (SELECT min(v) AS lo, (max(v) - min(v)) / 50 AS width FROM u),
    counts AS (SELECT least(CAST(floor((v - lo) / width) AS INTEGER), 49) AS bin,
        count(*) AS n FROM u, w GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + width * i, 6) AS low,
    round(lo + width * (i + 1), 6) AS high, coalesce(n, 0) AS n
    FROM range(50) r(i) CROSS JOIN w LEFT JOIN counts ON counts.bin = i""",
)
def _(t):
    return rounded(media.bitrate_histogram(t.recordings), "low", "high")


@query(
    "media_bitrate_by_source",
    f"""WITH {_RATES}, u AS (SELECT source, bitrate_mbps AS v FROM rates, lim
        WHERE bitrate_mbps <= hi),
    q AS (SELECT source, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3 FROM u GROUP BY 1),
    m AS (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS within
        FROM u JOIN q USING (source))
    SELECT source, count(*) AS n, round(any_value(q1), 6) AS q1,
    round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
    round(min(v) FILTER (WHERE within), 6) AS whisker_low,
    round(max(v) FILTER (WHERE within), 6) AS whisker_high,
    count(*) FILTER (WHERE NOT within) AS n_outliers FROM m GROUP BY 1""",
)
def _(t):
    found = media.bitrate_by_source(t.recordings)
    return rounded(found, "q1", "median", "q3", "whisker_low", "whisker_high")


# ------------------------------------------------------------------ modifications


@query(
    "modifications_events",
    """SELECT count(*) AS n_events, count(*) FILTER (WHERE revision_number = 1) AS n_initial,
    count(*) FILTER (WHERE revision_number <> 1) AS n_subsequent,
    count(last_modified) AS n_dated FROM {recordings}""",
)
def _(t):
    return modifications.revision_events(t.recordings)


@query(
    "modifications_by_year",
    """SELECT CAST(year(last_modified) AS INTEGER) AS year, count(*) AS n,
    CASE WHEN year(last_modified) <= 2025 THEN 'shown' ELSE 'after' END AS part
    FROM {recordings} WHERE last_modified IS NOT NULL GROUP BY 1, 3""",
)
def _(t):
    return modifications.by_year(t.recordings)


@query(
    "modifications_recent_months",
    """SELECT CAST(date_trunc('month', last_modified) AS TIMESTAMP) AS month_start,
    CAST(year(any_value(last_modified)) AS INTEGER) AS year,
    CAST(month(any_value(last_modified)) AS INTEGER) AS month, count(*) AS n
    FROM {recordings} WHERE last_modified IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 60""",
)
def _(t):
    return modifications.recent_months(t.recordings)


# ------------------------------------------------------------------ org units

_USUAL = """usual AS (SELECT * FROM {units} WHERE type IS NULL OR type NOT IN
    (SELECT type FROM {units} WHERE type IS NOT NULL GROUP BY 1 HAVING count(*) = 1))"""
_COURSES = """c AS (SELECT *, CAST(CASE WHEN trim(coalesce(code, '')) = '' THEN 0
    ELSE len(regexp_split_to_array(trim(code), '\\s+')) END AS INTEGER) AS code_token_count,
    coalesce(contains(lower(name), 'x-list'), false) AS has_xlist_keyword
    FROM {units} WHERE type = 'Course Offering')"""


@query(
    "orgunits_type_counts",
    f"""WITH {_USUAL} SELECT type, count(*) AS n FROM usual WHERE type IS NOT NULL
    GROUP BY 1""",
)
def _(t):
    return orgunits.type_counts(orgunits.usual_types(t.units))


@query(
    "orgunits_ratios",
    """WITH k AS (SELECT count(*) FILTER (WHERE type = 'Course Offering') AS a,
    count(*) FILTER (WHERE type = 'Section') AS b,
    count(*) FILTER (WHERE type = 'Group') AS z FROM {units})
    SELECT a AS n_courses, b AS n_sections, z AS n_groups,
    round(b / a, 6) AS sections_per_course, round(z / a, 6) AS groups_per_course,
    round(z / b, 6) AS groups_per_section, b - a AS sections_minus_courses FROM k""",
)
def _(t):
    found = orgunits.ratios(t.units)
    return rounded(
        found, "sections_per_course", "groups_per_course", "groups_per_section"
    )


def _courses(t):
    return orgunits.with_cross_list_hints(orgunits.of_kind(t.units))


@query(
    "orgunits_cross_list_counts",
    f"""WITH {_COURSES} SELECT count(*) FILTER (WHERE code_token_count > 1)
    AS n_many_tokens, count(*) FILTER (WHERE has_xlist_keyword) AS n_keyword FROM c""",
)
def _(t):
    return orgunits.cross_list_counts(_courses(t))


@query(
    "orgunits_token_distribution",
    f"""WITH {_COURSES} SELECT code_token_count, count(*) AS n FROM c GROUP BY 1
    ORDER BY n DESC, 1 LIMIT 10""",
)
def _(t):
    return orgunits.token_distribution(_courses(t))


@query(
    "orgunits_cross_list_sample",
    f"""WITH {_COURSES} SELECT org_unit_id, name, code, code_token_count FROM c
    WHERE code_token_count > 1 ORDER BY org_unit_id LIMIT 10""",
)
def _(t):
    return orgunits.cross_list_sample(_courses(t))


_ACTIVE = """count(*) FILTER (WHERE is_active) AS n_active,
    count(*) FILTER (WHERE NOT is_active) AS n_inactive, count(*) AS total,
    round(count(*) FILTER (WHERE is_active) * 100 / count(*), 6) AS pct_active"""


@query(
    "orgunits_active_by_type",
    f"""WITH {_USUAL} SELECT type AS group_value, {_ACTIVE} FROM usual
    WHERE type IS NOT NULL GROUP BY 1""",
)
def _(t):
    return rounded(orgunits.active_by(orgunits.usual_types(t.units)), "pct_active")


@query(
    "orgunits_active_shares",
    """SELECT is_active, count(*) AS n, round(count(*) * 100 / (SELECT count(*)
    FROM {units} WHERE type = 'Course Offering'), 1) AS pct
    FROM {units} WHERE type = 'Course Offering' GROUP BY 1""",
)
def _(t):
    return orgunits.active_shares(orgunits.of_kind(t.units))


@query(
    "orgunits_active_by_start_year",
    f"""SELECT CAST(year(start_date) AS INTEGER) AS group_value, {_ACTIVE} FROM {{units}}
    WHERE type = 'Course Offering' AND start_date IS NOT NULL GROUP BY 1
    ORDER BY 1 DESC LIMIT 15""",
)
def _(t):
    found = orgunits.active_by_start_year(orgunits.of_kind(t.units))
    return rounded(found, "pct_active")


@query(
    "orgunits_group_sample",
    """SELECT org_unit_id, name, code, is_active FROM {units} WHERE type = 'Group'
    ORDER BY org_unit_id LIMIT 10""",
)
def _(t):
    return orgunits.group_sample(t.units)


# ------------------------------------------------------------------ quiz configuration

_QUIZ_FLAGS = quizconfig.QUIZ_FLAGS


def _label(flag: str) -> str:
    return flag.replace("_", " ").title()


def _prevalence_sql(names, where: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS flag, '{_label(f)}' AS feature,
        count(*) FILTER (WHERE {f}) AS n,
        round(count(*) FILTER (WHERE {f}) * 100 / count(*), 6) AS pct
        FROM {{quizzes}} WHERE {where}"""
        for f in names
    )


@query("quizconfig_feature_use", _prevalence_sql(_QUIZ_FLAGS, "true"))
def _(t):
    return rounded(quizconfig.feature_use(t.quizzes), "pct")


_N_FLAGS = " + ".join(f"coalesce(CAST({f} AS INTEGER), 0)" for f in _QUIZ_FLAGS)


@query(
    "quizconfig_features_per_quiz",
    f"""SELECT CAST({_N_FLAGS} AS INTEGER) AS n_flags, count(*) AS n,
    round(count(*) * 100 / (SELECT count(*) FROM {{quizzes}}), 6) AS pct
    FROM {{quizzes}} GROUP BY 1""",
)
def _(t):
    return rounded(quizconfig.features_per_quiz(t.quizzes), "pct")


@query(
    "quizconfig_many_features",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_N_FLAGS} >= 3) AS n_many,
    round(count(*) FILTER (WHERE {_N_FLAGS} >= 3) * 100 / count(*), 6) AS pct_many
    FROM {{quizzes}}""",
)
def _(t):
    return rounded(quizconfig.many_features(t.quizzes), "pct_many")


@query(
    "quizconfig_features_given",
    _prevalence_sql([f for f in _QUIZ_FLAGS if f != "ip_restricted"], "ip_restricted"),
)
def _(t):
    return rounded(quizconfig.features_given(t.quizzes), "pct")


@query(
    "quizconfig_school_rates",
    f"""WITH s AS (SELECT org_unit_id, upper(coalesce(
        nullif(regexp_extract(code, '^([A-Za-z]{{3,}})', 1), ''),
        nullif(regexp_extract(name, '^([A-Za-z]{{3,}})', 1), ''), 'UNKNOWN')) AS school
        FROM {{units}})
    SELECT coalesce(school, 'UNKNOWN') AS school, count(DISTINCT quiz_id) AS n_items,
    count(*) AS n_rows,
    {', '.join(f'round(avg(coalesce(CAST({f} AS INTEGER), 0)) * 100, 6) AS pct_{f}'
               for f in _QUIZ_FLAGS)}
    FROM {{quizzes}} LEFT JOIN s USING (org_unit_id) GROUP BY 1
    ORDER BY n_items DESC, 1 LIMIT 15""",
)
def _(t):
    found = quizconfig.school_rates(t.quizzes, t.units)
    return rounded(found, *[f"pct_{f}" for f in _QUIZ_FLAGS])


# ------------------------------------------------------------------ join patterns


@query(
    "dictionary_content_per_course",
    """SELECT u.org_unit_id, type, name, count(content_object_id) AS content_count
    FROM {units} u LEFT JOIN {content} c ON u.org_unit_id = c.org_unit_id
    WHERE type = 'Course Offering' AND is_active GROUP BY 1, 2, 3""",
)
def _(t):
    return dictionary.content_per_course(t.units, t.content)


@query(
    "dictionary_learning_path",
    """SELECT c.org_unit_id, c.content_object_id, c.parent_content_object_id,
    c.title AS topic_name, c.depth, c.sort_order, p.title AS module_name,
    r.name AS prerequisite_type FROM {content} c
    LEFT JOIN {content} p ON c.parent_content_object_id = p.content_object_id
    LEFT JOIN {conditions} r ON c.content_object_id = r.result_id""",
)
def _(t):
    return dictionary.learning_path(t.content, t.conditions)


@query(
    "dictionary_assessment_items",
    """SELECT g.grade_object_id, g.name AS grade_item_name, round(max_points, 6)
    AS max_points, weight, quiz_id, quiz_name, time_limit, attempts_allowed,
    coalesce(n, 0) AS unlocks_count FROM {grades} g
    LEFT JOIN {quizzes} q ON g.grade_object_id = q.grade_object_id
    LEFT JOIN (SELECT id1, count(*) AS n FROM {conditions}
        WHERE pre_requisite_tool_id = 51000 GROUP BY 1) r ON g.grade_object_id = id1
    WHERE type_name = 'Numeric'""",
)
def _(t):
    found = dictionary.assessment_items(t.grades, t.quizzes, t.conditions)
    return rounded(found, "max_points")


@query(
    "dictionary_media_in_content",
    """SELECT content_id, c.title, c.org_unit_id, type, duration,
    round(revision_size / 1048576, 6) AS size_mb, required_transcribing
    FROM {recordings} m JOIN (SELECT DISTINCT content_id, object_id1 FROM
        (SELECT DISTINCT content_id FROM {recordings} WHERE type = 'Video'),
        (SELECT DISTINCT object_id1 FROM {content} WHERE tool_id = 699000)
        WHERE contains(CAST(object_id1 AS VARCHAR), content_id)) USING (content_id)
    JOIN {content} c USING (object_id1) WHERE type = 'Video' AND tool_id = 699000""",
)
def _(t):
    return rounded(dictionary.media_in_content(t.recordings, t.content), "size_mb")


@query(
    "dictionary_graded_forums",
    """SELECT forum_id, f.name AS forum_name, must_post_to_participate, f.result_id,
    grade_object_id, g.name AS grade_item_name, round(max_points, 6) AS max_points,
    coalesce(n, 0) AS prerequisite_count
    FROM {forums} f LEFT JOIN {grades} g ON f.result_id = g.result_id
    LEFT JOIN (SELECT result_id, count(*) AS n FROM {conditions}
        WHERE result_tool_id = 13000 GROUP BY 1) r ON f.result_id = r.result_id
    WHERE NOT f.is_deleted""",
)
def _(t):
    found = dictionary.graded_forums(t.forums, t.grades, t.conditions)
    return rounded(found, "max_points")


@query(
    "dictionary_course_profile",
    """WITH c AS (SELECT org_unit_id, count(DISTINCT content_object_id) AS n,
        bool_or(coalesce(tool_id = 699000, false)) AS uses FROM {content} WHERE NOT is_deleted GROUP BY 1),
    q AS (SELECT org_unit_id, count(DISTINCT quiz_id) AS n FROM {quizzes}
        WHERE is_active GROUP BY 1),
    f AS (SELECT org_unit_id, count(DISTINCT forum_id) AS n FROM {forums}
        WHERE NOT is_deleted GROUP BY 1),
    g AS (SELECT org_unit_id, count(DISTINCT grade_object_id) AS n,
        count(*) FILTER (WHERE type_name = 'Numeric') AS numeric_ FROM {grades}
        WHERE NOT is_deleted GROUP BY 1),
    r AS (SELECT org_unit_id, count(DISTINCT pre_requisite_id) AS n FROM {conditions}
        GROUP BY 1)
    SELECT u.org_unit_id, u.name AS course_name, u.type AS unit_type,
    coalesce(c.n, 0) AS content_items, coalesce(q.n, 0) AS quiz_count,
    coalesce(f.n, 0) AS forum_count, coalesce(g.n, 0) AS grade_items,
    coalesce(g.numeric_, 0) AS graded_items, coalesce(r.n, 0) AS release_conditions,
    round(CASE WHEN uses THEN (SELECT avg(duration) FROM {recordings}) END, 6)
        AS avg_video_duration
    FROM {units} u LEFT JOIN c ON c.org_unit_id = u.org_unit_id
    LEFT JOIN q ON q.org_unit_id = u.org_unit_id LEFT JOIN f ON f.org_unit_id = u.org_unit_id
    LEFT JOIN g ON g.org_unit_id = u.org_unit_id LEFT JOIN r ON r.org_unit_id = u.org_unit_id
    WHERE u.type = 'Course Offering' AND u.is_active""",
)
def _(t):
    found = dictionary.course_profile(
        t.units, t.content, t.quizzes, t.forums, t.grades, t.conditions, t.recordings
    )
    return rounded(found, "avg_video_duration")


@query(
    "dictionary_role_instances",
    """SELECT u.type AS unit_type, role_name, is_cascading, show_in_grades,
    show_in_content, count(*) AS role_instances FROM {roles} r
    JOIN {units} u ON r.org_unit_id = u.org_unit_id GROUP BY 1, 2, 3, 4, 5""",
)
def _(t):
    return dictionary.role_instances(t.roles, t.units)


@query(
    "dictionary_quizzes_with_grades",
    """SELECT quiz_id, quiz_name, q.grade_object_id, g.name AS grade_item_name
    FROM {quizzes} q LEFT JOIN {grades} g ON q.grade_object_id = g.grade_object_id""",
)
def _(t):
    return dictionary.quizzes_with_grades(t.quizzes, t.grades)


@query(
    "dictionary_grades_with_quizzes",
    """SELECT g.grade_object_id, associated_tool_item_id, quiz_id, quiz_name
    FROM {grades} g LEFT JOIN {quizzes} q ON associated_tool_item_id = quiz_id
    WHERE tool_id = 51000""",
)
def _(t):
    return dictionary.grades_with_quizzes(t.grades, t.quizzes)


@query(
    "dictionary_content_rules",
    """SELECT c.content_object_id, c.org_unit_id, pre_requisite_id, name FROM {content} c
    LEFT JOIN {conditions} r ON c.content_object_id = r.result_id
    AND r.result_tool_id = 37000""",
)
def _(t):
    return dictionary.content_rules(t.content, t.conditions)


@query(
    "dictionary_tool_objects",
    """WITH targets AS (SELECT 51000 AS tool_id, quiz_id AS object_id1, 'quiz' AS kind,
        quiz_id AS linked_id, quiz_name AS linked_name FROM {quizzes}
    UNION ALL SELECT tool_id, associated_tool_item_id, 'grade', grade_object_id, name
        FROM {grades})
    SELECT c.content_object_id, c.tool_id, c.object_id1, kind, linked_id, linked_name
    FROM {tool_content} c LEFT JOIN targets t
    ON c.tool_id = t.tool_id AND c.object_id1 = t.object_id1""",
)
def _(t):
    return dictionary.tool_objects(t.tool_content, t.quizzes, t.grades)


@query(
    "dictionary_tool_use",
    """SELECT tool_id, count(*) AS n, CASE tool_id WHEN 2000 THEN 'Assignments'
    WHEN 51000 THEN 'Quizzes' WHEN 699000 THEN 'Content Service' ELSE 'Other' END
    AS tool_name FROM {content} WHERE tool_id IS NOT NULL GROUP BY 1""",
)
def _(t):
    return dictionary.tool_use(t.content)


@query(
    "dictionary_role_overlay",
    """SELECT org_unit_id, type,
    (SELECT count(*) FROM {roles} r WHERE r.org_unit_id = u.org_unit_id) AS n_roles,
    (SELECT count(*) FROM {content} c WHERE c.org_unit_id = u.org_unit_id) AS n_items
    FROM {units} u""",
)
def _(t):
    return dictionary.role_overlay(t.roles, t.units, t.content)


@query(
    "dictionary_content_depth",
    "SELECT depth, count(*) AS n FROM {content} GROUP BY 1",
)
def _(t):
    return dictionary.content_depth(t.content)


@query(
    "dictionary_orphan_content",
    """SELECT count(*) AS n_referencing, count(*) FILTER (WHERE u.org_unit_id IS NULL)
    AS n_orphans, round(count(*) FILTER (WHERE u.org_unit_id IS NULL) / count(*), 6)
    AS pct_orphans FROM {content} c LEFT JOIN {units} u ON c.org_unit_id = u.org_unit_id""",
)
def _(t):
    return rounded(dictionary.orphan_content(t.content, t.units), "pct_orphans")


@query(
    "dictionary_current_state",
    """SELECT org_unit_id, name, content_object_id FROM (SELECT *, row_number() OVER
    (PARTITION BY org_unit_id ORDER BY depth DESC, name, content_object_id) AS place
    FROM (SELECT org_unit_id, title AS name, depth, content_object_id FROM {content}))
    WHERE place = 1""",
)
def _(t):
    rows = t.content.select(
        "org_unit_id", F.col("title").alias("name"), "depth", "content_object_id"
    )
    return dictionary.current_state(rows, ["org_unit_id"], version="depth").drop("depth")
