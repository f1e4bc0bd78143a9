"""The same results in plain SQL over the test tables, written apart from the
Spark code. ``PARTS`` are named subqueries; ``ORACLES`` use them by name."""

from __future__ import annotations

import re

PARTS = {
    "capacities": """
        SELECT 'cap' || n_nationkey AS capacity_id, n_name AS capacity_name,
               'F' || ((n_nationkey % 4 + 1) * 2) AS capacity_sku,
               'region ' || n_regionkey AS capacity_region, 'Active' AS capacity_state
        FROM nation""",
    "workspaces": """
        SELECT 'ws' || s_suppkey AS workspace_id, s_name AS workspace_name,
               CASE WHEN s_suppkey % 5 = 0 THEN 'PersonalGroup' ELSE 'Workspace' END AS workspace_type,
               CASE WHEN s_acctbal < 0 THEN 'Deleted' ELSE 'Active' END AS workspace_state,
               CASE WHEN s_suppkey % 7 = 6 THEN NULL
                    WHEN s_suppkey % 7 = 5 THEN 'old' || s_nationkey
                    ELSE 'cap' || s_nationkey END AS capacity_id
        FROM supplier""",
    "items": """
        SELECT 'i' || p_partkey AS item_id, p_name AS item_name,
               CASE p_size % 4 WHEN 0 THEN 'Report' WHEN 1 THEN 'SemanticModel'
                    WHEN 2 THEN 'Notebook' ELSE 'Lakehouse' END AS item_type,
               CASE WHEN p_size % 10 = 0 THEN 'Deleted' ELSE 'Active' END AS item_state,
               CASE WHEN p_partkey % 5 >= 3
                    THEN make_timestamp(2024, 1, p_size % 28 + 1, 8, 30, 0.0) END AS item_last_updated,
               'ws' || (p_partkey // 16) AS workspace_id,
               CASE WHEN p_partkey % 3 = 0 THEN 'f' || (p_partkey // 100) END AS folder_id,
               CASE WHEN p_partkey % 6 <> 0 THEN p_brand END AS creator_name,
               CASE WHEN p_partkey % 6 <> 0 THEN
                    CASE WHEN p_size % 3 = 0 THEN 'ServicePrincipal' ELSE 'User' END END AS creator_type
        FROM part""",
    "activity": """
        SELECT 'a' || event_id AS activity_id,
               CASE WHEN event_id % 1000 <> 999 THEN date_trunc('second', ts) END AS creation_time,
               event_type AS operation,
               event_type || ' ' || (k % 3) AS activity,
               CASE WHEN event_id % 97 = 0 THEN NULL
                    WHEN event_id % 4 = 0 THEN 'U' || user_id
                    WHEN event_id % 4 = 1 THEN 'CUST' || user_id || '@X.ORG'
                    WHEN event_id % 8 = 2 THEN 'Job' || (user_id % 9)
                    WHEN event_id % 8 = 6 THEN 'job' || (user_id % 9)
                    ELSE 'u' || user_id || '@corp.org' END AS user_id,
               user_id % 5 AS user_type,
               'W' || (k % 5) AS workload,
               'item ' || k AS item_name,
               CASE WHEN k % 20 <> 19 THEN 'space ' || (k % 20) END AS workspace_name,
               CASE WHEN event_type = 'signup' AND event_id % 11 = 0 THEN NULL
                    ELSE event_type <> 'error' END AS is_success
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events) e""",
    "workspace_principals": """
        SELECT 'ws' || (o_custkey // 16) AS workspace_id,
               CASE o_custkey % 10 WHEN 0 THEN 'g' || (o_custkey % 50)
                    WHEN 1 THEN 's' || (o_custkey // 16) ELSE 'u' || o_custkey END AS principal_id,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Person ' || o_custkey END AS display_name,
               CASE o_custkey % 10 WHEN 0 THEN 'Group' WHEN 1 THEN 'App' ELSE 'User' END AS principal_type,
               CASE WHEN o_custkey % 10 > 1 AND o_orderstatus <> 'P'
                    THEN 'Cust' || o_custkey || '@x.org' END AS email,
               o_orderpriority AS role
        FROM orders""",
    "item_principals": """
        SELECT CASE WHEN l_linenumber = 7 THEN 'x' ELSE 'i' END || l_partkey AS item_id,
               'ws' || l_suppkey AS workspace_id,
               CASE l_linenumber % 3 WHEN 0 THEN 's' || l_suppkey WHEN 1 THEN 'u' || l_partkey
                    ELSE 'g' || (l_suppkey % 50) END AS principal_id,
               CASE l_linenumber % 3 WHEN 0 THEN 'Robot ' || l_suppkey WHEN 1 THEN 'User ' || l_partkey
                    ELSE 'Team ' || (l_suppkey % 50) END AS display_name,
               CASE l_linenumber % 3 WHEN 0 THEN 'ServicePrincipal' WHEN 1 THEN 'User'
                    ELSE 'Group' END AS raw_type,
               CASE l_linenumber % 3 WHEN 0 THEN 'App' WHEN 1 THEN 'User' ELSE 'Group' END AS principal_type,
               CASE WHEN l_linenumber % 3 = 1 THEN 'user' || l_partkey || '@x.org' END AS email,
               CASE l_returnflag WHEN 'A' THEN 'Report' WHEN 'N' THEN 'SemanticModel'
                    ELSE 'Notebook' END AS item_type,
               l_tax, l_discount, l_linestatus, l_returnflag
        FROM lineitem""",
    "permissions": """
        SELECT *, 'Read' AS permission FROM item_principals WHERE l_tax <> 0 AND l_discount <> 0
        UNION ALL
        SELECT *, 'Write' FROM item_principals
        WHERE l_tax <> 0 AND l_discount <> 0 AND l_linestatus = 'O'
        UNION ALL
        SELECT *, 'Reshare' FROM item_principals
        WHERE l_tax <> 0 AND l_discount <> 0 AND l_returnflag = 'A'""",
    "directory": """
        SELECT 'u' || c_custkey AS principal_id, c_name AS display_name, 'User' AS principal_type,
               COALESCE(CASE WHEN c_acctbal >= 2000 THEN lower(c_mktsegment) || c_custkey || '@x.org' END,
                        'u' || c_custkey || '@corp.org') AS email
        FROM customer""",
    "users": """
        SELECT principal_id,
               substr(min(r || '|' || display_name), 3) AS display_name,
               substr(min(r || '|' || principal_type), 3) AS principal_type,
               substr(min(r || '|' || email), 3) AS email
        FROM (SELECT '0' AS r, principal_id, display_name, principal_type, email FROM workspace_principals
              UNION ALL
              SELECT '1', principal_id, display_name, principal_type, email FROM item_principals
              UNION ALL
              SELECT '2', principal_id, display_name, principal_type, email FROM directory) s
        GROUP BY principal_id""",
    "keys": """
        SELECT lower(principal_id) AS key FROM users
        UNION
        SELECT lower(email) FROM users WHERE email IS NOT NULL""",
    "services": """
        SELECT min(user_id) AS principal_id, min(user_id) AS display_name,
               'Service' AS principal_type, CAST(NULL AS VARCHAR) AS email
        FROM activity
        WHERE user_id IS NOT NULL AND lower(user_id) NOT IN (SELECT key FROM keys)
        GROUP BY lower(user_id)""",
    "dim_user": "SELECT * FROM users UNION ALL SELECT * FROM services",
    "lookup": """
        SELECT key, substr(min(r || '|' || principal_id), 3) AS principal_id
        FROM (SELECT lower(principal_id) AS key, '0' AS r, principal_id FROM dim_user
              UNION ALL
              SELECT lower(email), '1', principal_id FROM dim_user WHERE email IS NOT NULL) s
        GROUP BY key""",
    "fact_activity": """
        SELECT a.activity_id, a.creation_time, a.operation, a.activity, a.user_id AS user_id_raw,
               a.user_type, a.workload, a.item_name, a.workspace_name, a.is_success, l.principal_id
        FROM activity a LEFT JOIN lookup l ON lower(a.user_id) = l.key""",
    "dim_workspace": """
        SELECT w.*, c.capacity_name, c.capacity_sku, c.capacity_region, c.capacity_state
        FROM workspaces w LEFT JOIN capacities c ON w.capacity_id = c.capacity_id""",
    "dim_inventory": """
        SELECT i.*, w.workspace_name, w.workspace_type, w.workspace_state, w.capacity_id,
               w.capacity_name, w.capacity_sku, w.capacity_region, w.capacity_state
        FROM items i LEFT JOIN dim_workspace w ON i.workspace_id = w.workspace_id""",
    "usage_edges": """
        SELECT 'ws' || (p_partkey // 16) AS workspace_id, 'Dataset' AS source_type,
               'i' || p_partkey AS source_id, p_name AS source_name,
               'DatasourceUsage' AS relationship_type, 'Datasource' AS target_type,
               'd' || (p_size + n) AS target_id
        FROM part CROSS JOIN (VALUES (0), (1)) v(n)
        WHERE p_size % 4 = 1 AND p_size % 3 > n""",
    "edges": """
        SELECT * FROM usage_edges
        UNION ALL
        SELECT 'ws' || (p_partkey // 16), 'Report', 'i' || p_partkey, p_name,
               'DependsOnDataset', 'Dataset', 'i' || (p_partkey - p_partkey % 16)
        FROM part WHERE p_size % 4 = 0 AND p_partkey % 3 <> 0""",
    "fact_lineage": """
        SELECT e.source_id, e.relationship_type, e.target_id, e.target_type,
               COALESCE(i.item_name, 'Fuente Externa') AS target_name
        FROM edges e LEFT JOIN items i ON e.target_id = i.item_id""",
    "usage": """
        SELECT CASE event_id % 500 WHEN 7 THEN ts - INTERVAL 800 DAY WHEN 8 THEN NULL ELSE ts END AS ts,
               'cap' || (user_id % 3) AS capacity_id,
               CASE WHEN event_type IN ('view', 'click') THEN floor(value * 8) / 8 ELSE 0 END AS background,
               CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE floor(value * 8) / 8 END AS interactive
        FROM events""",
    "capacity_metrics": """
        SELECT CAST(date_trunc('hour', ts) AS DATE) AS date,
               CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start_of_hour, capacity_id,
               CAST(sum(background) AS DOUBLE) AS background_pct,
               CAST(sum(interactive) AS DOUBLE) AS interactive_pct
        FROM usage GROUP BY 1, 2, 3""",
    "calendar": """
        SELECT start_of_hour, CAST(start_of_hour AS DATE) AS date,
               CAST(extract('hour' FROM start_of_hour) AS BIGINT) AS hour,
               dayname(start_of_hour) AS day_of_week,
               isodow(start_of_hour) IN (6, 7) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(
                         CAST(max(CAST(ts AS DATE)) - INTERVAL 365 DAY AS TIMESTAMP),
                         CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL 23 HOUR,
                         INTERVAL 1 HOUR)) AS TIMESTAMP) AS start_of_hour
              FROM events) h""",
    "settings": """
        SELECT 'set' || p_partkey AS setting_name, p_name AS title, p_brand AS tenant_setting_group,
               p_size % 2 = 0 AS enabled, p_size % 3 = 0 AS can_specify_security_groups,
               CASE WHEN p_size % 3 <> 0 THEN p_size % 2 = 1 END AS delegate_to_capacity,
               CASE WHEN p_size % 5 = 0 THEN FALSE END AS delegate_to_domain,
               CASE WHEN p_size % 7 = 0 THEN TRUE END AS delegate_to_workspace
        FROM part""",
    "hour_averages": """
        SELECT date, start_of_hour, avg(background_pct) AS avg_background_pct,
               avg(interactive_pct) AS avg_interactive_pct
        FROM capacity_metrics GROUP BY date, start_of_hour""",
}


def _slicer(table: str, *columns: str) -> str:
    prefix = {
        "settings": "dim_tenant_setting",
        "calendar": "dim_date",
        "permissions": "fact_item_access",
        "workspace_principals": "fact_workspace_access",
    }.get(table, table)
    rename = {("permissions", "principal_type"): "raw_type"}
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{prefix}.{c}' AS slicer, "
        f"CAST({rename.get((table, c), c)} AS VARCHAR) AS value FROM {table}"
        for c in columns
    )


def _range_slicer(table: str, column: str) -> str:
    name = f"{'dim_date' if table == 'calendar' else table}.{column}"
    ends = f"SELECT unnest([min({column}), max({column})]) AS v FROM {table}"
    return f"SELECT DISTINCT '{name}' AS slicer, CAST(v AS VARCHAR) AS value FROM ({ends}) e"


# rows of each table with the two labels that are chosen on related tables
PARTS |= {
    "chosen_inventory": """
        SELECT i.*, w.capacity_name AS chosen_capacity
        FROM dim_inventory i LEFT JOIN dim_workspace w ON i.workspace_id = w.workspace_id""",
    "chosen_permissions": """
        SELECT p.item_type, p.raw_type AS principal_type, p.permission, i.chosen_capacity,
               u.principal_type AS chosen_type
        FROM permissions p LEFT JOIN chosen_inventory i ON p.item_id = i.item_id
        LEFT JOIN dim_user u ON p.principal_id = u.principal_id""",
    "chosen_access": """
        SELECT a.role, w.capacity_name AS chosen_capacity, u.principal_type AS chosen_type
        FROM workspace_principals a LEFT JOIN dim_workspace w ON a.workspace_id = w.workspace_id
        LEFT JOIN dim_user u ON a.principal_id = u.principal_id""",
    "chosen_activity": """
        SELECT f.*, u.principal_type AS chosen_type
        FROM fact_activity f LEFT JOIN dim_user u ON f.principal_id = u.principal_id""",
}


def _offered(prefix: str, table: str, condition: str, *columns: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{prefix}.{c}' AS slicer, CAST({c} AS VARCHAR) AS value FROM {table} WHERE {condition}"
        for c in columns
    )


_CAPACITY = "chosen_capacity IN ('NATION_1', 'NATION_4', 'NATION_8', 'NATION_12', 'NATION_20')"
_TYPE = "chosen_type IN ('User', 'Service')"
_WORKLOAD = "workload IN ('W1', 'W3')"


def _failed(condition: str = "TRUE") -> str:
    return f"""
        SELECT 'total_activities' AS measure,
               CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) AS value FROM fact_activity
        UNION ALL
        SELECT 'total_failed_activities',
               CAST(count(*) FILTER (WHERE NOT COALESCE(is_success, FALSE)) AS DOUBLE) FROM fact_activity
        UNION ALL
        SELECT 'pct_failed_activities',
               CAST(count(*) FILTER (WHERE NOT COALESCE(is_success, FALSE)) AS DOUBLE)
               / NULLIF(CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE), 0) FROM fact_activity"""


_BODIES = {
    "ingest_json": """
        SELECT a.activity_id, a.user_id, a.user_type, a.workload, a.is_success,
               CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) AS client_k,
               CASE WHEN event_id % 3 <> 0 THEN floor(e.value * 8) / 8 END AS amount,
               CAST(8 + (a.user_id IS NOT NULL)::INTEGER + (a.workspace_name IS NOT NULL)::INTEGER
                    + (a.is_success IS NOT NULL)::INTEGER + (event_id % 3 <> 0)::INTEGER AS BIGINT) AS n_fields
        FROM activity a JOIN events e ON a.activity_id = 'a' || e.event_id""",
    "flatten_pages": """
        SELECT 'u' || c_custkey AS id, c_name AS display_name,
               CASE WHEN c_acctbal >= 2000 THEN lower(c_mktsegment) || c_custkey || '@x.org' END AS mail,
               'u' || c_custkey || '@corp.org' AS user_principal_name,
               CASE WHEN c_nationkey = 0 THEN 'Guest' ELSE 'Member' END AS user_type
        FROM customer""",
    "page_chains": """
        SELECT list, CASE WHEN min(page) > 1 THEN 'start missing' ELSE 'breaks off' END AS fault,
               count(*) AS pages
        FROM (SELECT *, page - row_number() OVER (PARTITION BY list ORDER BY page) AS piece
              FROM (SELECT *, row_number() OVER (PARTITION BY list ORDER BY span) AS page,
                           count(*) OVER (PARTITION BY list) AS whole
                    FROM (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS list, c_custkey // 20 AS span
                          FROM customer) s) p
              WHERE (CAST(list AS INTEGER) * 7 + page * 5) % 11 <> 3) q
        GROUP BY list, piece, whole HAVING min(page) > 1 OR max(page) < whole""",
    "attach_parent_keys": """
        SELECT 'ws' || (o_custkey // 16) AS workspace_id, 'u' || o_custkey AS principal_id,
               o_orderkey AS grant_no
        FROM orders""",
    "parents_without_children": """
        SELECT workspace_id, workspace_name FROM workspaces
        WHERE workspace_id NOT IN (SELECT workspace_id FROM workspace_principals)""",
    "import_tabular": """
        SELECT date, start_of_hour, sum(background_pct) AS background_pct,
               sum(interactive_pct) AS interactive_pct, 'cap0' AS capacity_id
        FROM capacity_metrics GROUP BY date, start_of_hour""",
    "calendar_hours": "SELECT start_of_hour FROM calendar",
    "table_full_refresh": "SELECT workspace_id, principal_id, role FROM workspace_principals",
    "merge_insert_only": """
        SELECT 'a' || event_id AS activity_id,
               CASE WHEN ts < TIMESTAMP '2024-01-17' OR event_id % 1000 = 999
                    THEN 'first' ELSE 'second' END AS origin
        FROM events""",
    "merge_key_index": """
        SELECT 'a' || event_id AS activity_id,
               CASE WHEN ts < TIMESTAMP '2024-01-17' OR event_id % 1000 = 999
                    THEN 'first' ELSE 'second' END AS origin
        FROM events""",
    "build_since": """
        SELECT f.activity_id, f.creation_time, f.principal_id, f.user_id_raw, u.principal_type
        FROM fact_activity f LEFT JOIN dim_user u ON f.principal_id = u.principal_id""",
    "merge_composite_key": """
        SELECT *, CASE WHEN date < DATE '2024-01-17' THEN 'first' ELSE 'second' END AS origin
        FROM capacity_metrics WHERE date IS NOT NULL""",
    "rolling_window": """
        SELECT event_id, ts FROM events
        WHERE ts >= (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 27 DAY
          AND ts < (SELECT max(CAST(ts AS DATE)) FROM events) + INTERVAL 1 DAY""",
    "row_audit": """
        SELECT 'silver.workspace_access' AS table_name, count(*) AS row_count FROM orders
        UNION ALL SELECT 'silver.item_access', count(*) FROM permissions
        UNION ALL SELECT 'silver.activity', count(*) FROM events""",
    "audit_by_day": """
        SELECT CAST(creation_time AS DATE) AS event_date, count(*) AS bronze_rows, count(*) AS silver_rows,
               count(*) AS gold_rows, TRUE AS agrees
        FROM activity GROUP BY 1""",
    "preview_topn": """
        SELECT * FROM capacity_metrics ORDER BY date NULLS FIRST, start_of_hour NULLS FIRST, capacity_id LIMIT 1000""",
    "project_rename": "SELECT * FROM settings",
    "flatten_struct": "SELECT item_id, folder_id, creator_name, creator_type FROM items",
    "optional_field": """
        SELECT item_id, principal_id, email AS user_principal_name FROM item_principals""",
    "parse_timestamp": "SELECT activity_id, creation_time FROM activity",
    "sentinel_to_null": "SELECT item_id, item_last_updated FROM items",
    "normalize_code": "SELECT principal_id, principal_type, email FROM item_principals",
    "conditional_null": """
        SELECT principal_id, display_name, principal_type, email FROM workspace_principals""",
    "coalesce_cols": "SELECT principal_id, display_name, principal_type, email FROM directory",
    "filter_eq": """
        SELECT item_id, workspace_id FROM items
        WHERE item_name = 'small ring' AND item_type = 'SemanticModel'""",
    "filter_in": """
        SELECT activity_id, workspace_name FROM activity
        WHERE workspace_name IN ('space 3', 'space 7') OR workspace_name IS NULL""",
    "filter_known": "SELECT * FROM settings WHERE delegate_to_capacity IS NOT NULL",
    "filter_date_range": """
        SELECT activity_id, creation_time FROM activity
        WHERE creation_time >= TIMESTAMP '2024-01-10' AND creation_time < TIMESTAMP '2024-01-12'""",
    "search_values": """
        SELECT DISTINCT 'dim_tenant_setting.title' AS slicer, title AS value
        FROM settings WHERE lower(title) LIKE '%ring%'""",
    "dim_inventory": "SELECT * FROM dim_inventory",
    "dim_workspace": "SELECT * FROM dim_workspace",
    "merge_identities": "SELECT * FROM users",
    "known_keys": "SELECT key FROM keys",
    "service_actors": "SELECT * FROM services",
    "dim_user": "SELECT * FROM dim_user",
    "resolve_actor": "SELECT * FROM fact_activity",
    "explode_permissions": "SELECT item_id, principal_id, permission FROM permissions",
    "edges_nested": "SELECT * FROM usage_edges",
    "edges_union": "SELECT * FROM edges",
    "lineage_targets": "SELECT * FROM fact_lineage",
    "distinct_values": "SELECT DISTINCT user_id FROM activity",
    "calendar_attrs": "SELECT * FROM calendar",
    "hourly_summary": """
        SELECT * FROM capacity_metrics
        WHERE date BETWEEN (SELECT max(CAST(ts AS DATE)) FROM events) - 14
                       AND (SELECT max(CAST(ts AS DATE)) FROM events) - 1""",
    "spine_capacity": """
        SELECT c.date, c.start_of_hour, sum(m.background_pct) AS background_cu_pct,
               sum(m.interactive_pct) AS interactive_cu_pct
        FROM calendar c FULL JOIN capacity_metrics m ON c.start_of_hour = m.start_of_hour
        GROUP BY c.date, c.start_of_hour""",
    "capacity_matrix": """
        SELECT m.*,
               CASE WHEN NOT total_start_of_hour THEN avg_background_pct >=
                    (SELECT min(avg_background_pct)
                            + 0.003::DOUBLE * (max(avg_background_pct) - min(avg_background_pct))
                     FROM hour_averages) END AS background_flag,
               CASE WHEN NOT total_start_of_hour
                    THEN avg_interactive_pct >= 0.3::DOUBLE END AS interactive_flag
        FROM (SELECT date, start_of_hour, grouping(date) = 1 AS total_date,
                     grouping(start_of_hour) = 1 AS total_start_of_hour,
                     avg(background_pct) AS avg_background_pct,
                     avg(interactive_pct) AS avg_interactive_pct
              FROM capacity_metrics GROUP BY ROLLUP (date, start_of_hour)) m""",
    "flag_range_percent": """
        SELECT *, avg_background_pct >=
                  (SELECT min(avg_background_pct)
                          + 0.003::DOUBLE * (max(avg_background_pct) - min(avg_background_pct))
                   FROM hour_averages) AS background_flag
        FROM hour_averages""",
    "flag_threshold": """
        SELECT *, avg_interactive_pct >= 0.3::DOUBLE AS interactive_flag FROM hour_averages""",
    "measures_totals": """
        SELECT 'total_capacities' AS measure,
               CAST(count(DISTINCT capacity_id) + max(CASE WHEN capacity_id IS NULL THEN 1 ELSE 0 END)
                    AS DOUBLE) AS value FROM dim_workspace
        UNION ALL SELECT 'total_workspaces', CAST(count(*) AS DOUBLE) FROM dim_workspace
        UNION ALL SELECT 'total_items', CAST(count(*) AS DOUBLE) FROM dim_inventory""",
    "measures_capacity": """
        SELECT 'hours_over_100_pct_cu' AS measure,
               CAST(count(*) FILTER (WHERE background_pct > 100) AS DOUBLE) AS value FROM capacity_metrics
        UNION ALL SELECT 'background_cu_pct', sum(background_pct) FROM capacity_metrics
        UNION ALL SELECT 'interactive_cu_pct', sum(interactive_pct) FROM capacity_metrics""",
    "measures_users": """
        SELECT 'total_users' AS measure,
               CAST(count(*) FILTER (WHERE principal_type = 'User') AS DOUBLE) AS value FROM dim_user
        UNION ALL SELECT 'total_service_principals',
               CAST(count(*) FILTER (WHERE principal_type = 'Service') AS DOUBLE) FROM dim_user
        UNION ALL SELECT 'total_app_principals',
               CAST(count(*) FILTER (WHERE principal_type = 'App') AS DOUBLE) FROM dim_user
        UNION ALL SELECT 'total_security_groups',
               CAST(count(*) FILTER (WHERE principal_type = 'Group') AS DOUBLE) FROM dim_user""",
    "measures_activity": _failed(),
    "measure_override": _failed("is_success"),
    "measure_by_principal_type": """
        SELECT u.principal_type, count(*) AS total_activities,
               count(*) FILTER (WHERE NOT COALESCE(f.is_success, FALSE)) AS total_failed_activities,
               CAST(count(*) FILTER (WHERE NOT COALESCE(f.is_success, FALSE)) AS DOUBLE)
               / CAST(count(*) AS DOUBLE) AS pct_failed_activities
        FROM fact_activity f LEFT JOIN dim_user u ON f.principal_id = u.principal_id
        WHERE f.workload IN ('W1', 'W2', 'W3')
          AND (u.principal_type IN ('User', 'Service') OR u.principal_type IS NULL)
        GROUP BY u.principal_type""",
    "distinct_over_relation": """
        SELECT u.principal_type,
               count(DISTINCT f.principal_id) + max((f.principal_id IS NULL)::INTEGER) AS distinct_actors,
               count(*) AS total_activities,
               count(DISTINCT f.workspace_name) + max((f.workspace_name IS NULL)::INTEGER) AS distinct_workspaces
        FROM fact_activity f LEFT JOIN dim_user u ON f.principal_id = u.principal_id
        WHERE f.workload IN ('W1', 'W2')
          AND (u.principal_type IN ('User', 'Service') OR u.principal_type IS NULL)
        GROUP BY u.principal_type""",
    "activity_matrix": """
        SELECT workspace_name, workload, operation,
               grouping(workspace_name) = 1 AS total_workspace_name,
               grouping(workload) = 1 AS total_workload,
               grouping(operation) = 1 AS total_operation,
               count(*) AS total_activities
        FROM fact_activity GROUP BY ROLLUP (workspace_name, workload, operation)""",
    "report_inventory": """
        SELECT DISTINCT capacity_name, workspace_name, item_type, item_name, item_state,
               creator_type, creator_name
        FROM dim_inventory""",
    "report_settings": "SELECT DISTINCT * FROM settings",
    "report_workspace_access": """
        SELECT DISTINCT w.workspace_name, a.role, u.display_name, u.email
        FROM workspace_principals a
        LEFT JOIN dim_workspace w ON a.workspace_id = w.workspace_id
        LEFT JOIN dim_user u ON a.principal_id = u.principal_id""",
    "report_principals": "SELECT DISTINCT principal_type, display_name, email FROM dim_user",
    "star_item_access": """
        SELECT DISTINCT w.workspace_name, p.item_type, i.item_name, p.permission,
               p.raw_type AS principal_type, p.display_name AS principal_display_name,
               p.email AS user_principal_name
        FROM permissions p
        LEFT JOIN dim_inventory i ON p.item_id = i.item_id
        LEFT JOIN dim_workspace w ON i.workspace_id = w.workspace_id""",
    "report_activity": """
        SELECT DISTINCT f.workspace_name, f.activity, f.activity_id, f.creation_time, f.user_type,
               f.workload, f.is_success, f.item_name, u.principal_type, u.email
        FROM fact_activity f LEFT JOIN dim_user u ON f.principal_id = u.principal_id""",
    "report_lineage": """
        SELECT DISTINCT i.workspace_name, i.item_type, i.item_name, l.target_type,
               l.target_name, l.relationship_type
        FROM fact_lineage l LEFT JOIN dim_inventory i ON l.source_id = i.item_id""",
    "slicer_values": "\nUNION ALL\n".join(
        [
            _slicer("dim_workspace", "capacity_name", "workspace_name"),
            _slicer("dim_inventory", "creator_name", "item_state", "item_name", "item_type", "workspace_name"),
            _slicer(
                "settings", "delegate_to_domain", "delegate_to_workspace", "delegate_to_capacity",
                "tenant_setting_group", "setting_name", "title", "enabled",
            ),
            _range_slicer("calendar", "date"),
            _slicer("dim_user", "principal_type"),
            _slicer("permissions", "item_type", "principal_type", "permission"),
            _slicer("workspace_principals", "role"),
            _slicer("fact_activity", "activity", "workload", "workspace_name", "is_success"),
            _range_slicer("fact_activity", "creation_time"),
        ]
    ),
    "slicer_context": "\nUNION ALL\n".join(
        [
            _slicer("dim_workspace", "capacity_name"),
            _offered("dim_workspace", "dim_workspace", _CAPACITY.replace("chosen_capacity", "capacity_name"), "workspace_name"),
            _offered(
                "dim_inventory", "chosen_inventory", _CAPACITY,
                "creator_name", "item_state", "item_name", "item_type", "workspace_name",
            ),
            _slicer(
                "settings", "delegate_to_domain", "delegate_to_workspace", "delegate_to_capacity",
                "tenant_setting_group", "setting_name", "title", "enabled",
            ),
            _range_slicer("calendar", "date"),
            _slicer("dim_user", "principal_type"),
            _offered(
                "fact_item_access", "chosen_permissions", f"{_CAPACITY} AND {_TYPE}",
                "item_type", "principal_type", "permission",
            ),
            _offered("fact_workspace_access", "chosen_access", f"{_CAPACITY} AND {_TYPE}", "role"),
            _offered("fact_activity", "chosen_activity", _TYPE, "workload"),
            _offered(
                "fact_activity", "chosen_activity", f"{_TYPE} AND {_WORKLOAD}",
                "activity", "workspace_name", "is_success",
            ),
            f"""SELECT DISTINCT 'fact_activity.creation_time' AS slicer, CAST(v AS VARCHAR) AS value
            FROM (SELECT unnest([min(creation_time), max(creation_time)]) AS v
                  FROM chosen_activity WHERE {_TYPE} AND {_WORKLOAD}) e""",
        ]
    ),
    "activity_stream": """
        SELECT activity_id,
               COALESCE(strftime(creation_time, '%Y-%m-%dT%H:%M:%S'), 'not a date') AS creation_time,
               is_success
        FROM activity""",
}


def _with_parts(body: str) -> str:
    """The query with the parts it uses, directly or not, as subqueries."""
    used: list[str] = []

    def use(sql: str) -> None:
        for name in PARTS:
            if name not in used and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                use(PARTS[name])
                if name not in used:
                    used.append(name)

    use(body)
    if not used:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in used)
    return f"WITH {parts}\n{body.strip()}"


ORACLES = {name: _with_parts(body) for name, body in _BODIES.items()}
