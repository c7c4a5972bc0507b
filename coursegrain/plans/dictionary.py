"""Join patterns between the eight tables.

Facts are aggregated to the join key before they are joined, so no join
multiplies rows and every sum is a sum over the fact's own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import megabytes, row_count
from ..functions.names import col
from ..operators import hierarchy, joins, quality, ranking

QUIZ_TOOL = 51000
CONTENT_TOOL = 37000
MEDIA_TOOL = 699000
DISCUSSION_RESULT_TOOL = 13000

# Names of the tools.
TOOL_NAMES = {
    2000: "Assignments",
    3000: "Discussions",
    37000: "Content",
    51000: "Quizzes",
    699000: "Content Service",
}


def active(df: DataFrame, flag: str = "is_active") -> DataFrame:
    return df.where(col(flag))


def not_deleted(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return df.where(~col(flag))


def open_courses(units: DataFrame) -> DataFrame:
    return active(units).where(F.col("type") == "Course Offering")


def content_per_course(units: DataFrame, content: DataFrame) -> DataFrame:
    """``org_unit_id, type, name, content_count`` of the open courses."""
    hub = open_courses(units).select("org_unit_id", "type", "name")
    return joins.count_per_key(
        hub,
        content,
        {"org_unit_id": "org_unit_id"},
        "content_count",
        "content_object_id",
    )


def learning_path(
    content: DataFrame, conditions: DataFrame, org_unit_id: int | None = None
) -> DataFrame:
    """Topics with the title of their module and the kind of each prerequisite,
    in display order; one course, or all."""
    parents = content.select(
        F.col("content_object_id").alias("parent_id"), F.col("title").alias("module_name")
    )
    chosen = (
        content if org_unit_id is None else content.where(F.col("org_unit_id") == org_unit_id)
    )
    topics = chosen.select(
        "org_unit_id",
        "content_object_id",
        "parent_content_object_id",
        F.col("title").alias("topic_name"),
        "depth",
        "sort_order",
    )
    rules = conditions.select(
        F.col("result_id").alias("content_object_id"),
        F.col("name").alias("prerequisite_type"),
    )
    placed = joins.left_join(topics, parents, {"parent_content_object_id": "parent_id"})
    gated = joins.left_join(placed.drop("parent_id"), rules, "content_object_id")
    return gated.orderBy("org_unit_id", "sort_order", "content_object_id", "prerequisite_type")


def _rules_per(conditions: DataFrame, key: str, name: str) -> DataFrame:
    return (
        conditions.where(col(key).isNotNull())
        .groupBy(col(key).alias("rule_key"))
        .agg(F.count("pre_requisite_id").alias(name))
    )


def assessment_items(
    grades: DataFrame,
    quizzes: DataFrame,
    conditions: DataFrame,
    *,
    org_unit_id: int | None = None,
    tool: int = QUIZ_TOOL,
) -> DataFrame:
    """Numeric grade items with their quizzes and the number of conditions that
    they unlock."""
    items = grades.where(F.col("type_name") == "Numeric")
    if org_unit_id is not None:
        items = items.where(F.col("org_unit_id") == org_unit_id)
    items = items.select(
        "grade_object_id", F.col("name").alias("grade_item_name"), "max_points", "weight"
    )
    tests = quizzes.select(
        "grade_object_id", "quiz_id", "quiz_name", "time_limit", "attempts_allowed"
    )
    unlocks = _rules_per(
        conditions.where(F.col("pre_requisite_tool_id") == tool), "id1", "unlocks_count"
    )
    joined = joins.left_join(items, tests, "grade_object_id")
    return joins.left_join(joined, unlocks, {"grade_object_id": "rule_key"}).select(
        *joined.columns, F.coalesce("unlocks_count", F.lit(0)).alias("unlocks_count")
    )


def media_in_content(
    media: DataFrame, content: DataFrame, *, kind: str = "Video", tool: int = MEDIA_TOOL
) -> DataFrame:
    """Media items with the content objects whose object id holds their id."""
    items = media.where(F.col("type") == kind)
    places = content.where(F.col("tool_id") == tool).withColumn(
        "object_text", F.col("object_id1").cast("string")
    )
    # Ids repeat over revisions and placements: match distinct texts, then join back.
    texts = places.select("object_text", F.col("object_text").alias("text")).distinct()
    ids = items.select("content_id", F.col("content_id").alias("needle")).distinct()
    matches = joins.contains_join(
        texts, "object_text", "text", ids, "content_id", "needle"
    )
    return (
        places.select("object_text", "title", "org_unit_id")
        .join(matches, "object_text")
        .join(
            items.select(
                "content_id",
                "type",
                "duration",
                megabytes(F.col("revision_size")).alias("size_mb"),
                "required_transcribing",
            ),
            "content_id",
        )
        .drop("object_text")
    )


def graded_forums(
    forums: DataFrame,
    grades: DataFrame,
    conditions: DataFrame,
    *,
    org_unit_id: int | None = None,
    tool: int = DISCUSSION_RESULT_TOOL,
) -> DataFrame:
    """Live forums with their grade items and number of prerequisites."""
    live = not_deleted(forums)
    if org_unit_id is not None:
        live = live.where(F.col("org_unit_id") == org_unit_id)
    live = live.select(
        "forum_id", F.col("name").alias("forum_name"), "must_post_to_participate", "result_id"
    )
    items = grades.select(
        "result_id", "grade_object_id", F.col("name").alias("grade_item_name"), "max_points"
    )
    rules = _rules_per(
        conditions.where(F.col("result_tool_id") == tool), "result_id", "prerequisite_count"
    )
    joined = joins.left_join(live, items, "result_id")
    return joins.left_join(joined, rules, {"result_id": "rule_key"}).select(
        *joined.columns,
        F.coalesce("prerequisite_count", F.lit(0)).alias("prerequisite_count"),
    )


def course_profile(
    units: DataFrame,
    content: DataFrame,
    quizzes: DataFrame,
    forums: DataFrame,
    grades: DataFrame,
    conditions: DataFrame,
    media: DataFrame,
    *,
    tool: int = MEDIA_TOOL,
) -> DataFrame:
    """Open courses with the size of each of their parts.

    Each fact is reduced to one row per course first. The media table has no
    course key: a course that uses the media tool gets the mean duration over all
    media.
    """
    parts = [
        not_deleted(content)
        .groupBy("org_unit_id")
        .agg(
            F.count_distinct("content_object_id").alias("content_items"),
            F.bool_or(F.col("tool_id") == tool).alias("uses_media"),
        ),
        active(quizzes)
        .groupBy("org_unit_id")
        .agg(F.count_distinct("quiz_id").alias("quiz_count")),
        not_deleted(forums)
        .groupBy("org_unit_id")
        .agg(F.count_distinct("forum_id").alias("forum_count")),
        not_deleted(grades)
        .groupBy("org_unit_id")
        .agg(
            F.count_distinct("grade_object_id").alias("grade_items"),
            F.count_if(F.col("type_name") == "Numeric").alias("graded_items"),
        ),
        conditions.groupBy("org_unit_id").agg(
            F.count_distinct("pre_requisite_id").alias("release_conditions")
        ),
    ]
    profile = open_courses(units).select(
        "org_unit_id", F.col("name").alias("course_name"), F.col("type").alias("unit_type")
    )
    for part in parts:
        profile = profile.join(part, "org_unit_id", "left")
    mean_duration = media.agg(F.avg("duration")).scalar()
    counts = (
        "content_items",
        "quiz_count",
        "forum_count",
        "grade_items",
        "graded_items",
        "release_conditions",
    )
    return profile.select(
        "org_unit_id",
        "course_name",
        "unit_type",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.when(F.col("uses_media"), mean_duration).alias("avg_video_duration"),
    ).orderBy(F.desc("content_items"), "org_unit_id")


_ROLE_COLUMNS = ("role_name", "is_cascading", "show_in_grades", "show_in_content")


def role_instances(roles: DataFrame, units: DataFrame) -> DataFrame:
    """Roles by kind of unit and permissions. Roles are counted per unit before
    they meet the units."""
    per_unit = roles.groupBy("org_unit_id", *_ROLE_COLUMNS).agg(row_count().alias("n"))
    kinds = units.select("org_unit_id", F.col("type").alias("unit_type"))
    return (
        per_unit.join(kinds, "org_unit_id")
        .groupBy("unit_type", *_ROLE_COLUMNS)
        .agg(F.sum("n").alias("role_instances"))
    )


def quizzes_with_grades(quizzes: DataFrame, grades: DataFrame) -> DataFrame:
    """Quizzes with the grade item they point to."""
    items = grades.select("grade_object_id", F.col("name").alias("grade_item_name"))
    return joins.left_join(
        quizzes.select("quiz_id", "quiz_name", "grade_object_id"), items, "grade_object_id"
    )


def grades_with_quizzes(
    grades: DataFrame, quizzes: DataFrame, *, tool: int = QUIZ_TOOL
) -> DataFrame:
    """Grade items of the quiz tool with the quiz they point to."""
    tests = quizzes.select("quiz_id", "quiz_name")
    items = grades.where(F.col("tool_id") == tool).select(
        "grade_object_id", "associated_tool_item_id"
    )
    return joins.left_join(items, tests, {"associated_tool_item_id": "quiz_id"})


def content_rules(
    content: DataFrame, conditions: DataFrame, *, tool: int = CONTENT_TOOL
) -> DataFrame:
    """Content objects with the conditions that gate them as content."""
    rules = conditions.where(F.col("result_tool_id") == tool).select(
        F.col("result_id").alias("content_object_id"), "pre_requisite_id", "name"
    )
    return joins.left_join(
        content.select("content_object_id", "org_unit_id"), rules, "content_object_id"
    )


def tool_objects(
    content: DataFrame, quizzes: DataFrame, grades: DataFrame, *, quiz_tool: int = QUIZ_TOOL
) -> DataFrame:
    """``content_object_id, tool_id, object_id1, kind, linked_id, linked_name``: each
    content object with the quizzes and grade items its tool and object id point to.

    Ids are unique within a tool only, so the join is on both; the targets of all tools are
    one table, and content meets it once.
    """
    targets = quizzes.select(
        F.lit(quiz_tool).alias("tool_id"),
        F.col("quiz_id").alias("object_id1"),
        F.lit("quiz").alias("kind"),
        F.col("quiz_id").alias("linked_id"),
        F.col("quiz_name").alias("linked_name"),
    ).unionByName(
        grades.select(
            "tool_id",
            F.col("associated_tool_item_id").alias("object_id1"),
            F.lit("grade").alias("kind"),
            F.col("grade_object_id").alias("linked_id"),
            F.col("name").alias("linked_name"),
        )
    )
    own = content.select("content_object_id", "tool_id", "object_id1")
    return joins.left_join(own, targets, {"tool_id": "tool_id", "object_id1": "object_id1"})


def tool_use(df: DataFrame, *, tool: str = "tool_id") -> DataFrame:
    """``tool_id, n, tool_name``."""
    counts = df.where(col(tool).isNotNull()).groupBy(col(tool)).agg(row_count().alias("n"))
    return joins.lookup(counts, tool, TOOL_NAMES, "tool_name", default="Other")


def role_overlay(roles: DataFrame, units: DataFrame, fact: DataFrame) -> DataFrame:
    """``org_unit_id, type, n_roles, n_items`` of every unit."""
    hub = units.select("org_unit_id", "type")
    key = {"org_unit_id": "org_unit_id"}
    with_roles = joins.count_per_key(hub, roles, key, "n_roles", "org_unit_id")
    return joins.count_per_key(with_roles, fact, key, "n_items", "org_unit_id")


def content_depth(content: DataFrame) -> DataFrame:
    return hierarchy.depth_distribution(content, "depth")


def content_tree(content: DataFrame) -> DataFrame:
    return hierarchy.resolve_chains(
        content, "content_object_id", "parent_content_object_id"
    )


def orphan_content(content: DataFrame, units: DataFrame) -> DataFrame:
    return quality.orphan_summary(content, "org_unit_id", units, "org_unit_id")


def current_state(df: DataFrame, keys: list[str], *, version: str = "version") -> DataFrame:
    """The highest version of each key; other columns break ties."""
    rest = [F.asc(c) for c in df.columns if c not in {*keys, version}]
    return ranking.latest_per_key(df, keys, [F.desc(version), *rest])
