"""Release conditions: which kinds are used, where, and how they combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import percent, row_count, share
from ..functions.names import col
from ..operators import distribution, frequency, joins

TOP_TYPES = 10
TOP_UNITS = 20
TOP_ITEMS = 15
UNIT_BINS = 30
ROLE_CONDITION = "Enrolled in current orgUnit as"

# What each condition type asks for.
CONDITION_PURPOSE = {
    "Mark on a Quiz": "Requires students to achieve a specific score on a quiz",
    "Completed Quiz Attempt": (
        "Requires students to complete a quiz attempt (regardless of score)"
    ),
    "Content topic visited": (
        "Requires students to access/view a specific content topic"
    ),
    "Submission to dropbox": "Requires students to submit an assignment to a dropbox",
    "Section Enrollment": (
        "Restricts access based on which section/cohort a student is enrolled in"
    ),
    "Group Membership": (
        "Restricts access based on group assignment within the course"
    ),
    "Enrolled in current orgUnit as": (
        "Restricts access based on enrollment role "
        "(student, TA, instructor, auditor)"
    ),
    "Content topic completed": (
        "Requires completion of a content topic "
        "(marked as complete by student or system)"
    ),
    "Mark on a Grade Item": "Requires a specific grade on any gradebook item",
    "Discussion posts to topic / forum": (
        "Requires a minimum number of discussion posts in a specific forum/topic"
    ),
}


def type_usage(conditions: DataFrame, *, k: int = TOP_TYPES) -> DataFrame:
    """``name, n, pct, n_units, intensity, purpose`` of the k most used types;
    percent of all conditions."""
    total = conditions.agg(row_count()).scalar()
    used = frequency.use_by_group(conditions, "name", "org_unit_id")
    top = used.orderBy(F.desc("n"), "name").limit(k)
    described = joins.lookup(top, "name", CONDITION_PURPOSE, "purpose")
    return described.select(
        "name", "n", percent(F.col("n"), total).alias("pct"), "n_units", "intensity", "purpose"
    )


def of_type(conditions: DataFrame, name: str = ROLE_CONDITION) -> DataFrame:
    return conditions.where(F.col("name") == name)


def type_totals(conditions: DataFrame, name: str = ROLE_CONDITION) -> DataFrame:
    """One row on one type: rows, units, rows per unit, inclusive and exclusive."""
    return (
        of_type(conditions, name)
        .agg(
            row_count().alias("n"),
            F.count_distinct("org_unit_id").alias("n_units"),
            F.count_if(F.col("is_negative_condition")).alias("n_negative"),
        )
        .select(
            "n",
            "n_units",
            share(F.col("n"), F.col("n_units")).alias("intensity"),
            (F.col("n") - F.col("n_negative")).alias("n_positive"),
            "n_negative",
        )
    )


def operators_of_type(conditions: DataFrame, name: str = ROLE_CONDITION) -> DataFrame:
    return frequency.value_counts(of_type(conditions, name), "operator_type_desc")


def busiest_units(
    conditions: DataFrame, name: str = ROLE_CONDITION, *, k: int = TOP_UNITS
) -> DataFrame:
    return frequency.most_common(of_type(conditions, name), "org_unit_id", k)


def unit_histogram(
    conditions: DataFrame, name: str = ROLE_CONDITION, *, bins: int = UNIT_BINS
) -> DataFrame:
    """Histogram of conditions per unit."""
    per_unit = frequency.value_counts(of_type(conditions, name), "org_unit_id")
    return distribution.histogram(per_unit, "n", bins)


def unit_median(conditions: DataFrame, name: str = ROLE_CONDITION) -> DataFrame:
    per_unit = frequency.value_counts(of_type(conditions, name), "org_unit_id")
    return distribution.percentiles(per_unit, "n", [0.5]).toDF("median")


def per_item(conditions: DataFrame) -> DataFrame:
    """``result_id, item_count, org_unit_id`` of each gated item."""
    return frequency.items_per_key(
        conditions, "result_id", "name", carried="org_unit_id"
    )


def item_distribution(conditions: DataFrame) -> DataFrame:
    return frequency.count_of_counts(per_item(conditions))


def item_complexity(conditions: DataFrame) -> DataFrame:
    return frequency.complexity(per_item(conditions))


def most_complex_items(conditions: DataFrame, *, k: int = TOP_ITEMS) -> DataFrame:
    return per_item(conditions).orderBy(F.desc("item_count"), "result_id").limit(k)


def totals(conditions: DataFrame) -> DataFrame:
    return frequency.distinct_totals(
        conditions, n_types="name", n_units="org_unit_id", n_items="result_id"
    )
