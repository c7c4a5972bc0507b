"""Joins, set operations, hierarchies and deduplication as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frequency, hierarchy, joins, ranking
from ..plans import dictionary
from .registry import query, rounded


@query(
    "left_join_default",
    """SELECT o_orderkey, o_custkey, coalesce(segment, 'UNKNOWN') AS segment
    FROM orders LEFT JOIN (SELECT c_custkey, segment FROM {dirty_customer})
    ON o_custkey = c_custkey""",
)
def _(t):
    dimension = t.dirty_customer.select(
        F.col("c_custkey").alias("o_custkey"), "segment"
    )
    facts = t.orders.select("o_orderkey", "o_custkey")
    return joins.left_join_default(facts, dimension, "o_custkey", "segment", "UNKNOWN")


@query(
    "star_join_counts",
    """SELECT c_custkey, c_name, count(o_orderkey) AS n_orders FROM customer
    LEFT JOIN {strayed_orders} ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def _(t):
    hub = t.customer.select("c_custkey", "c_name")
    return joins.count_per_key(
        hub, t.strayed_orders, {"c_custkey": "o_custkey"}, "n_orders", "o_orderkey"
    )


@query(
    "self_join_hierarchy",
    """SELECT c.node, c.role, c.turn, p.role AS parent_role FROM {turn_edges} c
    LEFT JOIN {turn_edges} p ON c.parent_node = p.node ORDER BY c.node""",
)
def _(t):
    linked = hierarchy.with_parent(t.turn_edges, "node", "parent_node", {"role": "parent_role"})
    return linked.select("node", "role", "turn", "parent_role").orderBy("node")


@query(
    "conditional_left_join",
    """SELECT o_orderkey, count(l_partkey) AS n_first FROM orders
    LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 1 GROUP BY 1""",
)
def _(t):
    return joins.count_per_key(
        t.orders.select("o_orderkey"),
        t.lineitem.where("l_linenumber = 1"),
        {"o_orderkey": "l_orderkey"},
        "n_first",
        "l_partkey",
    )


@query(
    "split_hot_key",
    """WITH refs AS (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_orderkey % 5 < 3 THEN 7 ELSE l_partkey END AS p_partkey FROM lineitem)
    SELECT p_partkey, p_brand, count(*) AS n FROM refs LEFT JOIN part USING (p_partkey)
    GROUP BY 1, 2""",
)
def _(t):
    """60 % of the references are to one part."""
    referred = F.when(F.col("l_orderkey") % 5 < 3, 7).otherwise(F.col("l_partkey"))
    refs = t.lineitem.select("l_orderkey", "l_linenumber", referred.alias("p_partkey"))
    named = joins.split_join(refs, t.part.select("p_partkey", "p_brand"), "p_partkey", how="left", rows=5_000)
    return frequency.value_counts(named, "p_partkey", "p_brand")


@query(
    "contains_join",
    """SELECT doc_id, item_id FROM documents d JOIN benchmark b
    ON contains(d.text, b.text)""",
)
def _(t):
    return joins.contains_join(t.documents, "doc_id", "text", t.benchmark, "item_id", "text")


@query(
    "contains_join_short",
    """SELECT p_partkey, word FROM part
    JOIN (SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM part) w
    ON contains(p_name, word)""",
)
def _(t):
    words = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word")).distinct()
    needles = words.select("word", F.col("word").alias("sought"))
    return joins.contains_join(t.part, "p_partkey", "p_name", needles, "word", "sought")


@query(
    "inner_join_multikey_group",
    """SELECT n_regionkey, c_mktsegment, count(*) AS n FROM customer
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def _(t):
    per_nation = frequency.value_counts(t.customer, "c_nationkey", "c_mktsegment")
    regions = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return (
        per_nation.join(regions, "c_nationkey")
        .groupBy("n_regionkey", "c_mktsegment")
        .agg(F.sum("n").alias("n"))
    )


@query(
    "both_way_linkage",
    """SELECT o_orderkey, grade_key, n AS n_lines FROM {linked_orders} LEFT JOIN
    (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON grade_key = l_orderkey""",
)
def _(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("grade_key")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    return joins.left_join(
        t.linked_orders.select("o_orderkey", "grade_key"), lines, "grade_key"
    ).select("o_orderkey", "grade_key", "n_lines")


@query(
    "dimension_lookup",
    """SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'south' WHEN 1 THEN 'west'
    WHEN 2 THEN 'east' ELSE 'other' END AS side FROM customer""",
)
def _(t):
    sides = {0: "south", 1: "west", 2: "east"}
    found = joins.lookup(t.customer, "c_nationkey", sides, "side", default="other")
    return found.select("c_custkey", "side")


@query(
    "overlay_join",
    """SELECT n_nationkey, n_name, r_name,
    (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers,
    (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    hub = joins.left_join(t.nation, t.region, {"n_regionkey": "r_regionkey"}).select(
        "n_nationkey", "n_name", "r_name"
    )
    with_customers = joins.count_per_key(
        hub, t.customer, {"n_nationkey": "c_nationkey"}, "n_customers", "c_custkey"
    )
    return joins.count_per_key(
        with_customers, t.supplier, {"n_nationkey": "s_nationkey"}, "n_suppliers", "s_suppkey"
    )


# ------------------------------------------------------------------ key sets


def _linkage(t):
    linked = F.col("grade_key").isNotNull() & (F.col("o_totalprice") > 450000)
    return joins.key_linkage(t.linked_orders, t.strayed_orders, "o_custkey", linked)


_LINKAGE_SQL = """keys AS (SELECT o_custkey, bool_or(l) AS has_left, bool_or(r) AS has_right,
    bool_or(k) AS has_link FROM (
    SELECT o_custkey, true AS l, false AS r,
        grade_key IS NOT NULL AND o_totalprice > 450000 AS k FROM {linked_orders}
    UNION ALL SELECT o_custkey, false, true, false FROM {strayed_orders}) GROUP BY 1)"""


@query("group_any", f"WITH {_LINKAGE_SQL} SELECT * FROM keys")
def _(t):
    return _linkage(t)


@query(
    "linkage_summary",
    f"""WITH {_LINKAGE_SQL} SELECT count(*) FILTER (WHERE has_left) AS n_left,
    count(*) FILTER (WHERE has_right) AS n_right,
    count(*) FILTER (WHERE has_left AND has_right) AS n_both,
    count(*) FILTER (WHERE has_left AND has_right AND has_link) AS n_linked,
    count(*) FILTER (WHERE has_left AND has_right AND NOT has_link) AS n_unlinked,
    round(count(*) FILTER (WHERE has_left AND has_right AND NOT has_link) * 100 /
        count(*) FILTER (WHERE has_left AND has_right), 6) AS pct_unlinked FROM keys""",
)
def _(t):
    return rounded(joins.linkage_summary(_linkage(t)), "pct_unlinked")


@query(
    "semi_keys",
    """SELECT c_custkey FROM customer
    INTERSECT SELECT o_custkey FROM {strayed_orders}""",
)
def _(t):
    strayed = t.strayed_orders.select(F.col("o_custkey").alias("c_custkey"))
    return joins.keys_in_both(t.customer, strayed, "c_custkey")


@query(
    "anti_keys",
    """SELECT c_custkey FROM customer
    EXCEPT SELECT o_custkey FROM {strayed_orders}""",
)
def _(t):
    strayed = t.strayed_orders.select(F.col("o_custkey").alias("c_custkey"))
    return joins.keys_only_left(t.customer, strayed, "c_custkey")


@query(
    "union_parts",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
)
def _(t):
    parts = [(t.customer, "c_", "c_custkey"), (t.supplier, "s_", "s_suppkey")]
    first, second = [
        df.select(F.col(key).alias("id"), F.col(f"{p}name").alias("name"), F.col(f"{p}nationkey").alias("nation"))
        for df, p, key in parts
    ]
    return first.unionByName(second)


@query(
    "complement_of_subset",
    """SELECT c_custkey, balance FROM {dirty_customer}
    WHERE NOT coalesce(balance <= 5000, false)""",
)
def _(t):
    kept = F.coalesce(F.col("balance") <= 5000, F.lit(False))
    return t.dirty_customer.where(~kept).select("c_custkey", "balance")


@query(
    "latest_version",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
    WHERE place = 1""",
)
def _(t):
    events = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    order = [F.desc("ts"), F.desc("event_id")]
    return ranking.latest_per_key(events, ["user_id"], order).drop("ts")


@query(
    "deduplicate",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS place FROM lineitem)
    WHERE place = 1""",
)
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    order = [
        F.desc("l_shipdate"),
        F.asc("l_partkey"),
        F.asc("l_suppkey"),
        F.asc("l_extendedprice"),
    ]
    kept = ranking.deduplicate(lines, ["l_orderkey", "l_linenumber"], order)
    return kept.drop("l_shipdate")


# ------------------------------------------------------------------ hierarchies


@query(
    "recursive_chain",
    """WITH RECURSIVE chain(node, root, depth) AS (
        SELECT node, node, CAST(0 AS BIGINT) FROM {turn_edges} WHERE parent_node IS NULL
        UNION ALL SELECT e.node, c.root, c.depth + 1 FROM {turn_edges} e
        JOIN chain c ON e.parent_node = c.node)
    SELECT node, root, depth, 'rooted' AS status FROM chain""",
)
def _(t):
    return hierarchy.resolve_chains(t.turn_edges, "node", "parent_node")


@query(
    "recursive_content_tree",
    """WITH RECURSIVE ends(node, root, depth, status) AS (
        SELECT content_object_id, content_object_id, CAST(0 AS BIGINT), 'rooted'
        FROM {content} WHERE parent_content_object_id IS NULL
        UNION ALL SELECT c.content_object_id, c.parent_content_object_id, 1, 'orphan'
        FROM {content} c LEFT JOIN {content} p
            ON c.parent_content_object_id = p.content_object_id
        WHERE c.parent_content_object_id IS NOT NULL AND p.content_object_id IS NULL),
    chain(node, root, depth, status) AS (
        SELECT * FROM ends
        UNION ALL SELECT e.content_object_id, c.root, c.depth + 1, c.status
        FROM {content} e JOIN chain c ON e.parent_content_object_id = c.node)
    SELECT node AS content_object_id, root, depth, status FROM chain""",
)
def _(t):
    return dictionary.content_tree(t.content)


@query(
    "prerequisite_reach",
    """WITH RECURSIVE e AS (SELECT l_partkey AS a, l_suppkey + 1000000000 AS b
        FROM lineitem
        UNION SELECT l_suppkey + 1000000000, l_linenumber + 2000000000 FROM lineitem),
    walk(a, b, steps) AS (SELECT a, b, CAST(1 AS BIGINT) FROM e
        UNION SELECT w.a, e.b, w.steps + 1 FROM walk w JOIN e ON w.b = e.a)
    SELECT a, b, min(steps) AS steps FROM walk GROUP BY 1, 2""",
)
def _(t):
    supplier = F.col("l_suppkey") + 1_000_000_000
    step = F.col("l_linenumber").cast("long") + 2_000_000_000
    first = t.lineitem.select(F.col("l_partkey").alias("a"), supplier.alias("b"))
    second = t.lineitem.select(supplier, step)
    return hierarchy.prerequisite_reach(first.union(second), "a", "b")


@query(
    "depth_distribution",
    "SELECT turn AS depth, count(*) AS n FROM conversations GROUP BY 1",
)
def _(t):
    return hierarchy.depth_distribution(t.conversations, "turn")


@query(
    "wide_profile",
    """SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)
        AS n_customers,
    (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers,
    (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000)
        AS n_rich, round((SELECT avg(l_quantity) FROM lineitem), 6) AS mean_quantity
    FROM nation""",
)
def _(t):
    key = {"n_nationkey": "c_nationkey"}
    hub = t.nation.select("n_nationkey")
    customers = joins.count_per_key(hub, t.customer, key, "n_customers", "c_custkey")
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count_distinct("s_suppkey").alias("n_suppliers"),
        F.count_if(F.col("s_acctbal") > 5000).alias("n_rich"),
    )
    mean = t.lineitem.agg(F.avg("l_quantity")).scalar()
    profile = customers.join(suppliers, "n_nationkey", "left").select(
        "n_nationkey",
        "n_customers",
        F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"),
        F.coalesce("n_rich", F.lit(0)).alias("n_rich"),
        mean.alias("mean_quantity"),
    )
    return rounded(profile, "mean_quantity")
