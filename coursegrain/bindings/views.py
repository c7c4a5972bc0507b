"""Derived inputs, stated once as SQL that both engines run.

The sample tables hold clean trade data. These views dirty them, or give them
the shape of the course tables; each is one projection of whole tables. ``{name}``
stands for the input.
"""

VIEWS = {
    "dirty_customer": """
        SELECT c_custkey,
               CASE c_custkey % 10
                    WHEN 0 THEN 'N/A' WHEN 1 THEN '  ' || c_name || '  '
                    WHEN 2 THEN '' WHEN 3 THEN chr(9)
                    WHEN 4 THEN c_name || chr(9) || '  x' ELSE c_name END AS name_raw,
               CASE WHEN c_custkey % 7 = 0
                    THEN 'mail user' || CAST(c_custkey AS STRING) || '@example.org now'
                    WHEN c_custkey % 11 = 0
                    THEN 'id A' || lpad(CAST(c_custkey AS STRING), 8, '0') || ' ok'
                    WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS contact,
               CASE c_custkey % 6
                    WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' T '
                    WHEN 3 THEN '0' WHEN 4 THEN 'maybe' END AS flag_raw,
               CASE c_custkey % 5
                    WHEN 0 THEN '1-2' WHEN 1 THEN '$1,234.50' WHEN 2 THEN '(100)'
                    WHEN 3 THEN '1.5e3' ELSE CAST(c_custkey AS STRING) END AS amount_raw,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance,
               CASE WHEN c_custkey % 17 = 0 THEN 'unknown' ELSE c_mktsegment END
                    AS segment,
               c_custkey % 3 <> 0 AS is_active
        FROM {customer}""",
    "rare_part": """
        SELECT p_partkey,
               CASE WHEN p_partkey IN (1, 2) THEN 'odd' || CAST(p_partkey AS STRING)
                    WHEN p_partkey % 19 = 0 THEN NULL ELSE p_type END AS ptype
        FROM {part}""",
    "strayed_orders": """
        SELECT o_orderkey, o_totalprice,
               CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END
                    AS o_custkey
        FROM {orders}""",
    "linked_orders": """
        SELECT *, CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_orderkey END AS grade_key
        FROM {orders}""",
    "media": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity * 60 END AS duration,
               l_extendedprice * 1000 AS revision_size,
               l_returnflag AS type, l_linestatus AS source
        FROM {lineitem}""",
    "part_flags": """
        SELECT p_partkey, p_brand, p_size > 25 AS f_big, p_retailprice > 950 AS f_dear,
               p_type = 'PROMO' AS f_promo, length(p_name) > 11 AS f_long
        FROM {part}""",
    "turn_edges": """
        SELECT conv_id, turn, role, conv_id * 1000000 + turn AS node,
               CASE WHEN turn > 0 THEN conv_id * 1000000 + turn - 1 END AS parent_node
        FROM {conversations}""",
    "camel_lines": """
        SELECT l_orderkey AS OrderKey, l_linenumber AS LineNumber, l_partkey AS partKey2,
               CASE WHEN l_linenumber = 3 THEN 'none' ELSE l_returnflag END AS RFlag,
               l_extendedprice AS price
        FROM {lineitem}""",
    # ------------------------------------------------ course-shaped inputs
    "units": """
        SELECT c_custkey AS org_unit_id,
               CASE WHEN c_custkey = 19 THEN 'odd type' WHEN c_custkey % 20 < 9
                    THEN 'Course Offering' WHEN c_custkey % 20 < 16 THEN 'Section'
                    WHEN c_custkey % 20 < 19 THEN 'Group' END AS type,
               CASE WHEN c_custkey % 6 = 0 THEN 'Nursing X-List ' || c_name
                    WHEN c_custkey % 6 = 1 THEN NULL ELSE c_name END AS name,
               CASE c_custkey % 4
                    WHEN 0 THEN 'COMP ' || CAST(c_custkey AS STRING) || '  20'
                    WHEN 1 THEN 'nurs' || CAST(c_custkey AS STRING)
                    WHEN 2 THEN '7' || c_mktsegment END AS code,
               CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE
                    CAST(CAST(2006 + c_custkey % 19 AS STRING) || '-09-01' AS TIMESTAMP)
                    END AS start_date,
               c_custkey % 3 <> 0 AS is_active, c_custkey % 5 AS version
        FROM {customer}""",
    "quizzes": """
        SELECT o_orderkey AS quiz_id,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL
                    ELSE 'Quiz ' || CAST(o_orderkey % 37 % 14 AS STRING) END AS quiz_name,
               o_custkey AS org_unit_id,
               CASE WHEN o_orderkey % 29 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL '16' YEAR END AS creation_date,
               CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_orderkey END
                    AS grade_object_id,
               o_orderkey % 10 <> 0 AS is_active,
               CAST(30 + o_orderkey % 60 AS INT) AS time_limit,
               CAST(1 + o_orderkey % 3 AS INT) AS attempts_allowed,
               o_orderkey % 7 = 0 AS has_password,
               o_orderkey % 4 = 0 AS ip_restricted,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END
                    AS time_limit_enforced,
               o_orderkey % 13 < 3 AS prevent_moving_backwards,
               o_totalprice > 250000 AS allow_hints,
               o_orderstatus = 'F' AS display_in_calendar,
               o_orderkey % 19 = 0 AS is_retake_incorrect_only
        FROM {orders}""",
    "grades": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1000000000
                    ELSE o_orderkey END AS grade_object_id,
               o_custkey AS org_unit_id,
               'Item ' || o_orderpriority AS name,
               CASE WHEN o_orderkey % 4 = 0 THEN 'Text' ELSE 'Numeric' END AS type_name,
               o_totalprice / 1000 AS max_points,
               CAST(o_orderkey % 10 AS DOUBLE) AS weight,
               CAST(CASE WHEN o_orderkey % 2 = 0 THEN 51000 ELSE 2000 END AS INT)
                    AS tool_id,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS associated_tool_item_id,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey END AS result_id,
               o_orderkey % 8 = 0 AS is_deleted
        FROM {orders}""",
    "conditions": """
        SELECT l_orderkey * 10 + l_linenumber AS pre_requisite_id,
               l_orderkey AS result_id, l_partkey AS org_unit_id,
               CASE l_linenumber
                    WHEN 1 THEN 'Mark on a Quiz' WHEN 2 THEN 'Completed Quiz Attempt'
                    WHEN 3 THEN 'Content topic visited'
                    WHEN 4 THEN 'Enrolled in current orgUnit as'
                    WHEN 5 THEN 'Group Membership' WHEN 6 THEN 'Local rule' END AS name,
               l_returnflag = 'R' AS is_negative_condition,
               CAST(CASE WHEN l_linenumber <= 2 THEN 51000 ELSE 37000 END AS INT)
                    AS pre_requisite_tool_id,
               l_suppkey * 3 AS id1,
               CAST(CASE WHEN l_linestatus = 'O' THEN 13000 ELSE 37000 END AS INT)
                    AS result_tool_id,
               CASE WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN NULL
                    ELSE l_linestatus END AS operator_type_desc
        FROM {lineitem}""",
    "content": """
        SELECT o_orderkey AS content_object_id,
               CASE WHEN o_orderkey % 101 = 0 THEN o_custkey + 1000000000
                    ELSE o_custkey END AS org_unit_id,
               'Title ' || CAST(o_orderkey % 97 AS STRING) AS title,
               CASE WHEN o_orderkey < 50 THEN NULL
                    WHEN o_orderkey % 997 = 0 THEN o_orderkey + 1000000000
                    ELSE CAST(floor(o_orderkey / 8) AS BIGINT) END
                    AS parent_content_object_id,
               CAST(CASE o_orderkey % 5 WHEN 0 THEN 51000 WHEN 1 THEN 2000
                    WHEN 2 THEN 13 WHEN 3 THEN 699000 END AS INT) AS tool_id,
               (o_orderkey * 7919 + 100000) * 10 + o_orderkey % 10 AS object_id1,
               o_orderkey % 9 = 0 AS is_deleted,
               CAST(o_orderkey % 6 AS INT) AS depth,
               CAST(o_orderkey % 17 AS INT) AS sort_order
        FROM {orders}""",
    "tool_content": """
        SELECT content_object_id, tool_id,
               CASE WHEN content_object_id % 7 = 0 THEN NULL
                    WHEN tool_id = 51000 THEN content_object_id
                    ELSE content_object_id + content_object_id % 2 END AS object_id1
        FROM {content}""",
    "forums": """
        SELECT p_partkey AS forum_id, CAST(floor(p_partkey / 2) AS BIGINT) AS org_unit_id,
               p_name AS name, p_size > 25 AS must_post_to_participate,
               CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey END AS result_id,
               p_partkey % 7 = 0 AS is_deleted
        FROM {part}""",
    "roles": """
        SELECT s_suppkey * 2 AS org_unit_id, s_suppkey % 4 AS role_id,
               'Role ' || CAST(s_suppkey % 4 AS STRING) AS role_name,
               s_suppkey % 5 = 0 AS is_cascading, s_acctbal > 5000 AS show_in_grades,
               s_acctbal > 2000 AS show_in_content
        FROM {supplier}""",
    "recordings": """
        SELECT CAST(l_partkey * 7919 + 100000 AS STRING) AS content_id,
               l_linenumber AS revision_number,
               CASE WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN NULL
                    WHEN l_returnflag = 'A' THEN 'Audio' ELSE 'Video' END AS type,
               'Source ' || CAST(l_suppkey % 4 AS STRING) AS source,
               CAST(floor(l_extendedprice * 1000) AS BIGINT) AS revision_size,
               CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity * 60 AS INT) END
                    AS duration,
               l_tax > 0.04 AS required_transcoding,
               l_discount > 0.05 AS required_transcribing,
               CASE WHEN l_linenumber = 5 THEN NULL
                    ELSE l_shipdate + INTERVAL '24' YEAR END AS last_modified
        FROM {lineitem}""",
}
