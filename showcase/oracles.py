"""The queries' results as plain SQL for DuckDB, over views of the test tables."""

from __future__ import annotations

from showcase import pairs


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n"


ORDERS = dict(
    s=pairs.ORDERS_SOURCE,
    t=f"""SELECT order_id AS o_orderkey, cust_id AS o_custkey, total AS o_totalprice,
                 status AS o_orderstatus, ordered AS o_orderdate, priority AS o_orderpriority
          FROM ({pairs.ORDERS_TARGET}) x""",
)


def _variants(keys: list[str], columns: list[str]) -> str:
    names = ", ".join(keys + columns)
    return f"SELECT {names}, count(*) AS n FROM {{0}} GROUP BY ALL"


def _joined(keys: list[str], columns: list[str], sides: dict[str, str]) -> dict[str, str]:
    """Distinct rows of both sides, joined on null-safe keys."""
    on = " AND ".join(f"sv.{k} IS NOT DISTINCT FROM tv.{k}" for k in keys)
    both = ", ".join(f"coalesce(sv.{k}, tv.{k}) AS {k}" for k in keys)
    cells = ", ".join(f"sv.{c} AS s_{c}, tv.{c} AS t_{c}" for c in columns)
    cells = cells and ", " + cells
    return {
        **sides,
        "sv": _variants(keys, columns).format("s"),
        "tv": _variants(keys, columns).format("t"),
        "j": f"SELECT {both}{cells}, sv.n AS sn, tv.n AS tn FROM sv FULL OUTER JOIN tv ON {on}",
    }


def _cells(keys: list[str], columns: list[str], sides: dict[str, str]) -> dict[str, str]:
    k = ", ".join(keys)
    same = " AND ".join(f"totals.{c} IS NOT DISTINCT FROM x.{c}" for c in keys)
    own = ", ".join(f"x.{c}" for c in keys)
    totals = f"""
        SELECT {k}, CAST(sum(a) AS BIGINT) AS st, CAST(sum(b) AS BIGINT) AS tt
        FROM (SELECT {k}, 1 AS a, 0 AS b FROM s UNION ALL SELECT {k}, 0, 1 FROM t) u GROUP BY {k}"""
    missing = f"""
        SELECT {k}, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS source_value,
               CAST(NULL AS VARCHAR) AS target_value,
               CASE WHEN tt = 0 THEN 'missing_in_target' ELSE 'missing_in_source' END AS kind,
               st + tt > 1 AS repeated, st AS src_n, tt AS tgt_n, st + tt AS joined_rows
        FROM totals WHERE st = 0 OR tt = 0"""
    once = [
        f"""
        SELECT {own}, '{c}', CAST(s_{c} AS VARCHAR), CAST(t_{c} AS VARCHAR),
               CASE WHEN s_{c} IS NULL OR t_{c} IS NULL THEN 'null_vs_value' ELSE 'value' END,
               false, st, tt, CAST(1 AS BIGINT)
        FROM j x JOIN totals ON {same}
        WHERE st = 1 AND tt = 1 AND s_{c} IS DISTINCT FROM t_{c}"""
        for c in columns
    ]
    values = [
        f"""
        SELECT {own}, '{c}', CASE WHEN src_n > 0 THEN value END, CASE WHEN tgt_n > 0 THEN value END,
               CASE WHEN value IS NULL THEN 'null_vs_value' ELSE 'value' END, true,
               src_n, tgt_n, src_n * (tt - tgt_n)
        FROM (SELECT {k}, value, CAST(sum(a) AS BIGINT) AS src_n, CAST(sum(b) AS BIGINT) AS tgt_n
              FROM (SELECT {k}, CAST({c} AS VARCHAR) AS value, 1 AS a, 0 AS b FROM s
                    UNION ALL SELECT {k}, CAST({c} AS VARCHAR), 0, 1 FROM t) u
              GROUP BY {k}, value) x JOIN totals ON {same}
        WHERE (st > 1 OR tt > 1) AND st > 0 AND tt > 0 AND (src_n < st OR tgt_n < tt)"""
        for c in columns
    ]
    lines = " UNION ALL ".join([missing, *once, *values])
    return {**_joined(keys, columns, sides), "totals": totals, "cells": lines}


def _rows(columns: list[str], sides: dict[str, str]) -> dict[str, str]:
    c = ", ".join(columns)
    return {
        **sides,
        "counted": f"""
            SELECT {c}, CAST(sum(a) AS BIGINT) AS src_n, CAST(sum(b) AS BIGINT) AS tgt_n
            FROM (SELECT {c}, 1 AS a, 0 AS b FROM s UNION ALL SELECT {c}, 0, 1 FROM t) u
            GROUP BY {c}""",
        "d": "SELECT * FROM counted WHERE src_n <> tgt_n",
    }


ORDER_COLUMNS = ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority"]
ORDER_CELLS = _with(**_cells(["o_orderkey"], ORDER_COLUMNS, ORDERS))
LINES = dict(s=pairs.LINES_SOURCE, t=pairs.LINES_TARGET)
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_CELLS = _with(**_cells(LINE_KEYS, LINE_COLUMNS, LINES))
LINE_ROWS = [*LINE_KEYS, *LINE_COLUMNS]

ORDERS_RENAMED = dict(
    s="""SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_totalprice AS total,
                o_orderstatus AS status, o_orderdate AS ordered, o_orderpriority AS priority
         FROM (""" + pairs.ORDERS_SOURCE + ") x",
    t=pairs.ORDERS_TARGET,
)
RENAMED_COLUMNS = ["order_id", "cust_id", "total", "status", "ordered", "priority"]

# Text read as the typed side's types; raw keeps what could not be read.
TEXT = dict(
    s="""SELECT CAST(order_key AS BIGINT) AS order_key, CAST(cust_key AS BIGINT) AS cust_key, TRY_CAST(total AS DECIMAL(18,2)) AS total,
                CASE WHEN TRY_CAST(total AS DECIMAL(18,2)) IS NULL THEN total END AS raw, status,
                ordered, urgency AS priority
         FROM (""" + pairs.ORDERS_AS_TEXT + ") x",
    t="SELECT order_key, cust_key, total, CAST(NULL AS VARCHAR) AS raw, status, ordered, priority FROM ("
    + pairs.ORDERS_TYPED + ") x",
)

ORDER_ONLY = """
SELECT coalesce(sum(greatest(src_n - tgt_n, 0)), 0) AS source_only,
       coalesce(sum(greatest(tgt_n - src_n, 0)), 0) AS target_only FROM d
"""

KEY_DIFF = """
SELECT o_orderkey, 'missing_in_target' AS kind FROM (SELECT o_orderkey FROM s EXCEPT SELECT o_orderkey FROM t) a
UNION ALL
SELECT o_orderkey, 'missing_in_source' FROM (SELECT o_orderkey FROM t EXCEPT SELECT o_orderkey FROM s) b
"""

LABEL_DIFF = """
SELECT doc_id, 'missing_in_target' AS kind FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) a
UNION ALL
SELECT doc_id, 'missing_in_source' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents) b
"""

RESULT_ROWS = """
SELECT 'cells' AS job_name, '{"o_orderkey":' || o_orderkey || '}' AS row_key, column_name,
       source_value, target_value, kind, (SELECT count(*) FROM cells) AS record_count FROM cells
"""
RESULT_KEYS = f"""
SELECT 'keys', '{{"order_id":' || o_orderkey || '}}', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR), kind, (SELECT count(*) FROM ({KEY_DIFF}) n) FROM ({KEY_DIFF}) k
"""
STORED = ORDER_CELLS + f"""
SELECT 'orders' AS job_name, 's2t' AS recon_type, '{{"o_orderkey":' || o_orderkey || '}}' AS row_key, column_name,
       source_value, target_value, kind, (SELECT count(*) FROM cells) AS record_count FROM cells
UNION ALL
SELECT 'orders', 'missing_extra_records', '{{"order_id":' || o_orderkey || '}}', CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), kind, (SELECT count(*) FROM ({KEY_DIFF}) n) FROM ({KEY_DIFF}) k
"""
RESULTS = ORDER_CELLS + RESULT_ROWS + " UNION ALL " + RESULT_KEYS


EVENTS = dict(s=pairs.EVENTS_SOURCE, t=pairs.EVENTS_TARGET)
EVENT_COLUMNS = ["event_id", "ts", "user_id", "amount", "props"]
HOT_CELLS = _with(**_cells(["event_type"], EVENT_COLUMNS, EVENTS)) + "SELECT * FROM cells"

MAPPING_PIECES = """
SELECT job_name, CAST(pos AS INTEGER) AS pos, string_split(column_mapping, ',')[pos + 1] AS piece
FROM jobs, unnest(range(len(string_split(column_mapping, ',')))) AS u(pos)
WHERE column_mapping IS NOT NULL
"""

SEVERITY = """CASE status WHEN 'STARTED' THEN 0 WHEN 'SUCCESS' THEN 1 WHEN 'WARNING' THEN 2
              WHEN 'FAILURE' THEN 3 ELSE 4 END"""
ROLLUP = f"""
SELECT job_name, run_id,
       CASE max({SEVERITY}) WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUCCESS' WHEN 2 THEN 'WARNING'
            WHEN 3 THEN 'FAILURE' ELSE 'ERROR' END AS status,
       count(*) AS events, count(*) FILTER (WHERE status = 'FAILURE') AS failures,
       count(*) FILTER (WHERE status = 'ERROR') AS errors
FROM audit GROUP BY job_name, run_id
"""

_N = "CAST(NULL AS BIGINT)"


def _suite_row(job, check, status, source="NULL", target="NULL", only=("NULL", "NULL"), ratio="NULL"):
    values = ", ".join(
        f"CAST(({v}) AS BIGINT) AS {n}"
        for v, n in zip(
            (source, target, *only), ("source_count", "target_count", "source_only", "target_only")
        )
    )
    return (
        f"SELECT '{job}' AS job_name, 'suite' AS run_id, '{check}' AS recon_type,"
        f" {status} AS status, {values}, CAST(({ratio}) AS DOUBLE) AS mismatch_ratio"
    )


def _failure_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'FAILURE' ELSE 'SUCCESS' END"


def _suite() -> str:
    def one_sided(rows: str, kind: str) -> str:
        return f"SELECT count(*) FROM {rows} WHERE kind = '{kind}'"

    cells = [one_sided("cells", k) for k in ("missing_in_target", "missing_in_source")]
    keys = [one_sided("key_diff", k) for k in ("missing_in_target", "missing_in_source")]
    labels = [one_sided("label_diff", k) for k in ("missing_in_target", "missing_in_source")]
    only = ["SELECT source_only FROM only_orders", "SELECT target_only FROM only_orders"]
    rules = ["SELECT source_only FROM only_rules", "SELECT target_only FROM only_rules"]
    n_s, n_t = "SELECT count(*) FROM s", "SELECT count(*) FROM t"
    n_d, n_l = "SELECT count(*) FROM documents", "SELECT count(*) FROM labels"
    ratio = f"CAST(({only[0]}) + ({only[1]}) AS DOUBLE) / greatest(({n_s}) + ({n_t}), 1)"
    rows = [
        _suite_row("documents_labelled", "missing_extra_records",
                   _failure_if("EXISTS (SELECT 1 FROM label_diff)"), only=labels),
        _suite_row("documents_labelled", "record_count",
                   _failure_if(f"({n_d}) <> ({n_l})"), n_d, n_l),
        _suite_row("orders_copied", "s2t",
                   _failure_if("EXISTS (SELECT 1 FROM cells)"), only=cells),
        _suite_row("orders_copied", "source_to_target",
                   _failure_if("EXISTS (SELECT 1 FROM d)"), only=only),
        _suite_row("orders_copied", "record_count",
                   _failure_if(f"({n_s}) <> ({n_t})"), n_s, n_t),
        _suite_row("orders_copied", "missing_extra_records",
                   _failure_if("EXISTS (SELECT 1 FROM key_diff)"), only=keys),
        _suite_row("orders_copied", "threshold",
                   _failure_if(f"{ratio} > 0.05"), n_s, n_t, only, ratio),
        _suite_row("orders_copied", "schema_drift", "'SUCCESS'"),
        _suite_row("orders_rules", "business_rule",
                   _failure_if("EXISTS (SELECT 1 FROM rule_d)"), only=rules),
    ]
    ctes = {
        **_cells(["o_orderkey"], ORDER_COLUMNS, ORDERS),
        "key_diff": KEY_DIFF,
        "label_diff": LABEL_DIFF,
        **{k: v for k, v in _rows(["o_orderkey", *ORDER_COLUMNS], {}).items()},
        "only_orders": ORDER_ONLY,
        **_rule_rows("rule_counted", "rule_d"),
        "only_rules": ORDER_ONLY.replace("FROM d", "FROM rule_d"),
    }
    return _with(**ctes) + " UNION ALL ".join(rows)


def _rule_rows(counted: str, diff: str) -> dict[str, str]:
    c = "cust_id, n_orders, total"
    return {
        "source_view": pairs.ORDERS_SOURCE,
        "rs": f"SELECT o_custkey AS cust_id, n_orders, total FROM ({pairs.RULE_TOTALS}) x",
        "rt": pairs.TOTALS_TARGET,
        counted: f"""SELECT {c}, CAST(sum(a) AS BIGINT) AS src_n, CAST(sum(b) AS BIGINT) AS tgt_n
            FROM (SELECT {c}, 1 AS a, 0 AS b FROM rs UNION ALL SELECT {c}, 0, 1 FROM rt) u
            GROUP BY {c}""",
        diff: f"SELECT * FROM {counted} WHERE src_n <> tgt_n",
    }


def _details(columns: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN s_{c} IS DISTINCT FROM t_{c} THEN '{c}:' || coalesce(CAST(s_{c} AS VARCHAR),"
        f" 'NULL') || '!=' || coalesce(CAST(t_{c} AS VARCHAR), 'NULL') END"
        for c in columns
    ) + ")"


SOURCE_VIEW = _with(source_view=pairs.ORDERS_SOURCE)

OWN_NAMES = ["kind", "src_n", "uncastable", "__row", "column_name", "repeated"]


def _shown(columns: list[str], text: str) -> str:
    """The columns as results show them."""
    return "SELECT " + ", ".join(f"{c} AS {c}_" for c in columns) + f" FROM ({text}) x"


NAMES = dict(s=_shown(OWN_NAMES, pairs.OWN_NAMES_SOURCE), t=_shown(OWN_NAMES, pairs.OWN_NAMES_TARGET))
NAME_ROWS = _with(**_rows([f"{c}_" for c in OWN_NAMES], NAMES))
NAME_CELLS = _with(**_cells(["kind_"], [f"{c}_" for c in OWN_NAMES[1:]], NAMES))
VECTORS = dict(s=pairs.VECTORS_SOURCE, t=pairs.VECTORS_TARGET)

ORACLES = {
    "src_malformed_lines": _with(x=pairs.ORDER_LINES) + """
        SELECT value AS line, CASE wrong WHEN 1 THEN 'fields' ELSE 'open quote' END AS reason
        FROM x WHERE wrong > 0""",
    "row_diff_by_digests": _with(**_rows(LINE_ROWS, LINES)) + "SELECT * FROM d",
    "row_diff_of_own_names": NAME_ROWS + "SELECT * FROM d",
    "s2t_cells_of_own_names": NAME_CELLS + "SELECT * REPLACE (rtrim(column_name, '_') AS column_name) FROM cells",
    "row_diff_of_vectors": _with(**_rows(["vec_id", "embedding", "label"], VECTORS)) + """
        SELECT * REPLACE (array_to_string(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',')
            AS embedding) FROM d""",
    "s2t_cells_of_vectors": _with(**_cells(["vec_id"], ["embedding", "label"], VECTORS)) + """
        SELECT * REPLACE (
            CASE WHEN column_name = 'embedding' THEN CAST(source_value IS NOT NULL AS VARCHAR) ELSE source_value END AS source_value,
            CASE WHEN column_name = 'embedding' THEN CAST(target_value IS NOT NULL AS VARCHAR) ELSE target_value END AS target_value)
        FROM cells""",
    "sink_rerun": _with(v=pairs.ORDERS_SOURCE, t=pairs.ORDERS_TARGET) + f"""
        , r AS (SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_totalprice AS total, o_orderstatus AS status,
                       o_orderdate AS ordered, o_orderpriority AS priority FROM v WHERE o_totalprice > 0),
        n AS (SELECT {', '.join(RENAMED_COLUMNS)}, sum(a) AS a, sum(b) AS b
              FROM (SELECT *, 1 AS a, 0 AS b FROM r UNION ALL SELECT *, 0, 1 FROM t) u GROUP BY ALL)
        SELECT 'orders' AS job_name, 'business_rule' AS recon_type, 'first' AS run_id,
               '{{"order_id":' || order_id || ',"cust_id":' || cust_id || ',"total":' || coalesce(CAST(total AS VARCHAR), 'null')
               || ',"status":"' || status || '","ordered":"' || strftime(ordered, '%Y-%m-%d %H:%M:%S.000000')
               || '","priority":"' || priority || '"}}' AS row_key,
               CASE WHEN a > b THEN 'source_only' ELSE 'target_only' END AS kind
        FROM n WHERE a <> b""",
    "src_csv": f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
        CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderstatus,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate, o_orderpriority
        FROM ({pairs.ORDERS_SOURCE}) x""",
    "src_dat": f"""SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in LINE_ROWS[:-1])},
        strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') AS l_shipdate
        FROM ({pairs.LINES_SOURCE}) x""",
    "src_text": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "src_parquet": "SELECT * FROM lineitem",
    "src_orc": "SELECT * FROM events",
    "src_json": "SELECT * FROM conversations",
    "src_table": "SELECT * FROM customer",
    "src_by_extension": "SELECT * FROM part",
    "src_query": "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1",
    "job_lookup": f"SELECT * FROM ({pairs.JOBS_OF_PARTS}) x WHERE job_name = 'part-42'",
    "audit_for_run": f"SELECT * FROM ({pairs.AUDIT_OF_EVENTS}) x WHERE run_id = 'run-8'",
    "parse_mappings": _with(jobs=pairs.JOBS_OF_PARTS, pieces=MAPPING_PIECES) + """
        SELECT job_name, pos, trim(string_split(piece, ':')[1]) AS src,
               trim(string_split(piece, ':')[2]) AS tgt,
               len(string_split(piece, ':')) = 2 AS valid
        FROM pieces""",
    "explode_checks": _with(
        jobs=pairs.JOBS_OF_PARTS,
        pieces=MAPPING_PIECES.replace("column_mapping", "checks"),
    ) + "SELECT job_name, pos, lower(trim(piece)) AS recon_type FROM pieces",
    "align_target_to_source": _with(**ORDERS) + "SELECT * FROM t",
    "align_source_to_target": _with(**ORDERS_RENAMED) + "SELECT * FROM s",
    "key_projection": _with(**ORDERS_RENAMED) + """
        SELECT order_id, 'source' AS side FROM s UNION ALL SELECT order_id, 'target' FROM t""",
    "align_types": _with(**TEXT)
    + "SELECT order_key, cust_key, total, status, ordered, raw AS unread_total FROM s",
    "null_aware_diff": """
        SELECT d.doc_id, quality IS DISTINCT FROM toxic AS quality_vs_toxic,
               quality IS DISTINCT FROM 1 AS quality_vs_one
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "s2t_cells": ORDER_CELLS + "SELECT * FROM cells",
    "s2t_cells_of_text": _with(**TEXT) + """
        SELECT coalesce(s.order_key, t.order_key) AS order_key, 'total' AS column_name,
               coalesce(s.raw, CAST(s.total AS VARCHAR)) AS source_value,
               CAST(t.total AS VARCHAR) AS target_value,
               CASE WHEN s.raw IS NOT NULL THEN 'uncastable'
                    WHEN s.total IS NULL OR t.total IS NULL THEN 'null_vs_value' ELSE 'value' END AS kind,
               false AS repeated, CAST(1 AS BIGINT) AS src_n, CAST(1 AS BIGINT) AS tgt_n,
               CAST(1 AS BIGINT) AS joined_rows
        FROM s JOIN t ON s.order_key = t.order_key
        WHERE s.raw IS NOT NULL OR s.total IS DISTINCT FROM t.total
        UNION ALL
        SELECT s.order_key, 'status', s.status, t.status, 'value', false, 1, 1, 1
        FROM s JOIN t ON s.order_key = t.order_key WHERE s.status <> t.status
        UNION ALL
        SELECT order_key, NULL, NULL, NULL, 'missing_in_target', false, 1, 0, 1
        FROM s WHERE order_key NOT IN (SELECT order_key FROM t)""",
    "s2t_cells_of_duplicates": LINE_CELLS + "SELECT * FROM cells",
    "s2t_cells_of_hot_keys": HOT_CELLS,
    "cell_mismatch_summary": LINE_CELLS + """
        SELECT column_name, kind, count(*) AS cells, CAST(sum(joined_rows) AS BIGINT) AS joined_rows
        FROM cells GROUP BY column_name, kind""",
    "mismatch_detail_text": LINE_CELLS + f"""
        SELECT l_orderkey, l_linenumber, {_details(LINE_COLUMNS)} AS mismatch_details,
               st AS src_n, tt AS tgt_n, CAST(1 AS BIGINT) AS joined_rows
        FROM j JOIN totals USING (l_orderkey, l_linenumber)
        WHERE st = 1 AND tt = 1 AND {_details(LINE_COLUMNS)} <> ''
        UNION ALL
        SELECT l_orderkey, l_linenumber, CASE WHEN column_name IS NULL THEN kind ELSE column_name || ':'
               || coalesce(source_value, target_value, 'NULL') || ' in ' || src_n
               || ' source rows and ' || tgt_n || ' target rows' END, src_n, tgt_n, joined_rows
        FROM cells WHERE repeated OR column_name IS NULL""",
    "duplicate_keys": _with(**LINES) + """
        SELECT l_orderkey, l_linenumber, CAST(sum(a) AS BIGINT) AS src_n, CAST(sum(b) AS BIGINT) AS tgt_n,
               CAST(sum(a) * sum(b) AS BIGINT) AS joined_rows
        FROM (SELECT l_orderkey, l_linenumber, 1 AS a, 0 AS b FROM s
              UNION ALL SELECT l_orderkey, l_linenumber, 0, 1 FROM t) u
        GROUP BY l_orderkey, l_linenumber HAVING sum(a) > 1 OR sum(b) > 1""",
    "row_diff": _with(**_rows(LINE_ROWS, LINES)) + "SELECT * FROM d",
    "row_diff_of_text": _with(**_rows(["order_key", "cust_key", "total", "status", "ordered", "priority", "raw"], TEXT)) + """
        SELECT * EXCLUDE (raw), raw AS unread_total FROM d""",
    "row_diff_of_documents": _with(
        **_rows(
            ["text", "lang", "n_chars"],
            dict(
                s="SELECT text, lang, n_chars FROM documents WHERE source < 'src2'",
                t="SELECT text, lang, n_chars FROM documents WHERE source >= 'src2'",
            ),
        )
    ) + "SELECT * FROM d",
    "s2t_rows": _with(**_rows(RENAMED_COLUMNS, ORDERS_RENAMED)) + "SELECT * FROM d",
    "diff_summary": _with(**_rows(LINE_ROWS, LINES)) + """
        SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count,
               (SELECT count(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t) a) AS source_only,
               (SELECT count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s) b) AS target_only""",
    "missing_extra_keys": _with(**ORDERS)
    + f"SELECT o_orderkey AS order_id, kind FROM ({KEY_DIFF}) x",
    "missing_labels": LABEL_DIFF,
    "record_count": _with(**ORDERS) + """
        SELECT source_count, target_count,
               CASE WHEN source_count = target_count THEN 'SUCCESS' ELSE 'FAILURE' END AS status
        FROM (SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count) c""",
    "threshold": _with(**_rows(RENAMED_COLUMNS, ORDERS_RENAMED), only_orders=ORDER_ONLY) + """
        SELECT source_count, target_count, source_only, target_only,
               CAST(source_only + target_only AS DOUBLE) / greatest(source_count + target_count, 1)
                   AS mismatch_ratio,
               CASE WHEN CAST(source_only + target_only AS DOUBLE) / greatest(source_count + target_count, 1) <= 0.05
                    THEN 'SUCCESS' ELSE 'FAILURE' END AS status
        FROM (SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count,
                     CAST(source_only AS BIGINT) AS source_only, CAST(target_only AS BIGINT) AS target_only
              FROM only_orders) c""",
    "schema_drift": _with(x=pairs.ORDERS_AS_TEXT) + """
        SELECT 'priority' AS column_name, 'only_in_target' AS drift, CAST(NULL AS VARCHAR) AS source_type,
               'string' AS target_type, CAST(NULL AS BIGINT) AS unreadable_rows
        UNION ALL
        SELECT 'urgency', 'only_in_source', 'string', NULL, NULL
        UNION ALL
        SELECT 'cust_key', 'type_differs', 'string', 'bigint',
               (SELECT count(*) FROM x WHERE TRY_CAST(cust_key AS BIGINT) IS NULL)
        UNION ALL
        SELECT 'order_key', 'type_differs', 'string', 'bigint',
               (SELECT count(*) FROM x WHERE TRY_CAST(order_key AS BIGINT) IS NULL)
        UNION ALL
        SELECT 'total', 'type_differs', 'string', 'decimal(18,2)',
               (SELECT count(*) FROM x WHERE TRY_CAST(total AS DECIMAL(18,2)) IS NULL)""",
    "summary_diff": _with(s=pairs.ORDERS_SOURCE, t=pairs.ORDERS_PARTLY) + """
        , n AS (SELECT o_orderpriority, (SELECT count(*) FROM s WHERE s.o_orderpriority = p.o_orderpriority) AS src_n,
                       (SELECT count(*) FROM t WHERE t.o_orderpriority = p.o_orderpriority) AS tgt_n
                FROM (SELECT DISTINCT o_orderpriority FROM s) p),
        d AS (SELECT DISTINCT o_orderpriority FROM ((SELECT * FROM s EXCEPT ALL SELECT * FROM t)
                                                    UNION ALL (SELECT * FROM t EXCEPT ALL SELECT * FROM s)) x)
        SELECT o_orderpriority, CASE WHEN tgt_n = 0 THEN 'missing_in_target' ELSE 'value' END AS kind, src_n, tgt_n
        FROM n JOIN d USING (o_orderpriority)""",
    "schema_drift_of_nested": """
        WITH t AS (SELECT typeof(turn) = 'BIGINT' AS wide FROM conversations LIMIT 1), n AS (SELECT count(*) AS n FROM conversations)
        SELECT * FROM (VALUES
            ('conv_id', 'type_differs', (SELECT CASE typeof(any_value(conv_id)) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' END FROM conversations), 'string', CAST(0 AS BIGINT)),
            ('message.turn', 'type_differs', 'string', (SELECT CASE WHEN wide THEN 'bigint' ELSE 'int' END FROM t), 0),
            ('message.text', 'only_in_source', 'string', NULL, NULL),
            ('message.n_chars', 'only_in_target', NULL, 'int', NULL),
            ('marks[]', 'type_differs', 'string', (SELECT CASE WHEN wide THEN 'bigint' ELSE 'int' END FROM t), (SELECT count(role) FROM conversations)),
            ('notes{value}', 'type_differs', 'string', 'int', (SELECT count(*) FROM conversations WHERE turn % 2 <> 0 OR turn IS NULL)),
            ('steps[].at', 'type_differs', 'double', (SELECT CASE WHEN wide THEN 'bigint' ELSE 'int' END FROM t), (SELECT count(turn) FROM conversations))
        ) v(column_name, drift, source_type, target_type, unreadable_rows)""",
    "stratified_preview": LINE_CELLS + """
        SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY column_name, kind
            ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, source_value NULLS FIRST, target_value NULLS FIRST,
                     repeated, src_n, tgt_n, joined_rows) <= 3""",
    "rule_filter": SOURCE_VIEW + pairs.RULE_FILTER,
    "rule_join_agg": SOURCE_VIEW + f"SELECT * FROM ({pairs.RULE_JOIN_AGG}) r",
    "rule_window": _with(source_view="SELECT * FROM lineitem") + pairs.RULE_WINDOW,
    "rule_vs_target": _with(**_rule_rows("rule_counted", "rule_d")) + "SELECT * FROM rule_d",
    "mismatch_preview": ORDER_CELLS + """
        SELECT * FROM cells ORDER BY o_orderkey NULLS FIRST, column_name NULLS FIRST LIMIT 10""",
    "tag_results": _with(**ORDERS) + f"""
        SELECT o_orderkey AS order_id, kind, 'orders' AS job_name, 's2t' AS recon_type,
               'FAILURE' AS status, CAST(1700000000000 AS BIGINT) AS start_time,
               CAST(1700000065000 AS BIGINT) AS end_time,
               CAST(65 AS BIGINT) AS total_time_taken_for_execution,
               (SELECT count(*) FROM ({KEY_DIFF}) n) AS record_count, 1 AS mismatch_count
        FROM ({KEY_DIFF}) x""",
    "run_rollup": _with(audit=pairs.AUDIT_OF_EVENTS) + ROLLUP,
    "run_report": _with(audit=pairs.AUDIT_OF_EVENTS, runs=ROLLUP, flags=pairs.JOB_FLAGS) + """
        SELECT a.job_name, a.run_id, a.recon_type, a.status, a.message, runs.status AS run_status,
               CASE WHEN runs.status = 'SUCCESS' THEN notify_on_success = 'Y'
                    ELSE notify_on_failure = 'Y' END AS should_notify
        FROM audit a JOIN runs ON a.job_name = runs.job_name AND a.run_id = runs.run_id
        JOIN flags ON a.job_name = flags.job_name""",
    "sink_table": RESULTS,
    "sink_parquet": STORED,
    "sink_orc": STORED,
    "sink_audit": f"""
        SELECT *, CAST(1700000000123 AS BIGINT) AS event_ts
        FROM ({pairs.AUDIT_OF_EVENTS}) x WHERE run_id = 'run-8'""",
    "suite_summary": _suite(),
}
