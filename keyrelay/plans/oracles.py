"""DuckDB oracle SQL for every registered query (run over the provided parquet tables).

Written independently of the Spark code: events are derived with the fixture rules,
pulls are plain joins/EXISTS, the index fold is computed with joins on the first
insert / last event / last attribute event of each key instead of aggregates.
Constants: dbid '00', run_ts TIMESTAMP '2024-02-01 00:00:00'.
"""

from __future__ import annotations

from ..sources.fixtures import PLAIN_VALUE_SQL, RAW_VALUE_SQL

CDC = """cdc AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS c_stm, date_trunc('second', ts) AS d_xgsj,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 0 ELSE 2 END AS data_state,
         CASE WHEN event_id % 11 <> 0 THEN 'BA' || CAST(event_id AS VARCHAR) END AS c_baah,
         CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value) AS INTEGER) END AS n_jbfy,
         CASE WHEN user_id % 2 = 0 THEN 'db_customer' ELSE 'db_supplier' END AS schema_name,
         ts AS apply_ts
  FROM events)"""

# decoded, valid events: remainders 0, 1, 2, 4, 5, 6 mod 97 and unparsable times of upserts are quarantined
EV = """ev AS (
  SELECT seq, c_stm,
         CASE WHEN seq % 97 = 3 OR seq % 13 = 0 THEN NULL ELSE d_xgsj END AS d_xgsj,
         data_state, c_baah, n_jbfy, schema_name, split_part(schema_name, '_', 2) AS ajzlx, apply_ts
  FROM cdc
  WHERE seq % 97 NOT IN (0, 1, 2, 4, 5, 6) AND NOT (seq % 97 = 3 AND data_state <> 0))"""

PULL_EV = "pe AS (SELECT * FROM ev WHERE data_state <> 0)"

META = [("data_state", "'1'"), ("dbid", "'00'"), ("dt", "'2024-02-01'"), ("update_time", "'2024-02-01 00:00:00'")]


def _pairs(pairs: list[tuple[str, str]]) -> str:
    """SQL of name=value texts joined by |, null values left out."""
    return "concat_ws('|', " + ", ".join(f"'{k}=' || CAST({v} AS VARCHAR)" for k, v in pairs) + ")"


def _record(table: str, fields: list[tuple[str, str]]) -> str:
    """SQL of a record's fields and metadata by name; metadata wins over a field of the same name."""
    own = {**dict(fields), **dict(META), "tableName": f"'{table}'"}
    return _pairs(sorted(own.items()))


# record table, schema of its events, source table x, key, source columns in order
SOURCES = [
    ("db_customer_t_customer", "db_customer", "customer", "x.c_custkey",
     [("c_stm", "x.c_custkey"), ("c_name", "x.c_name"), ("n_nation", "x.c_nationkey"), ("c_mktsegment", "x.c_mktsegment")]),
    ("db_customer_t_customer_order", "db_customer", "orders", "x.o_custkey",
     [("c_stm", "x.o_orderkey"), ("c_stm_customer", "x.o_custkey"), ("o_orderstatus", "x.o_orderstatus"),
      ("o_orderpriority", "x.o_orderpriority")]),
    ("db_customer_t_label", "db_customer", "labels", "x.doc_id",
     [("c_stm", "x.doc_id"), ("n_quality", "x.quality"), ("data_state", "x.toxic")]),
    ("db_customer_t_customerws", "db_customer", "documents", "x.doc_id",
     [("c_stm_customer", "x.doc_id"), ("lang", "x.lang"), ("source", "x.source"), ("n_chars", "x.n_chars")]),
    ("db_supplier_t_supplier", "db_supplier", "supplier", "x.s_suppkey",
     [("c_stm", "x.s_suppkey"), ("s_name", "x.s_name"), ("n_nation", "x.s_nationkey")]),
    ("db_supplier_t_lineitem", "db_supplier", "lineitem", "x.l_suppkey",
     [("c_stm", "CAST(x.l_orderkey AS VARCHAR) || '-' || CAST(x.l_linenumber AS VARCHAR)"), ("c_stm_supplier", "x.l_suppkey"),
      ("l_returnflag", "x.l_returnflag"), ("l_linestatus", "x.l_linestatus")]),
]


def _pulled(table: str, schema: str, source: str, key: str, fields: list[tuple[str, str]]) -> str:
    return (f"SELECT '{table}' AS tableName, e.seq, e.c_stm, 1 AS data_state, {_pairs(fields)} AS row, "
            f"{_record(table, fields)} AS body FROM pe e JOIN {source} x ON CAST({key} AS VARCHAR) = e.c_stm "
            f"WHERE e.schema_name = '{schema}'")


EXTRA = """CASE WHEN seq % 97 = 7 THEN '{"a":[1,2]}' END"""

TOMBSTONES = f"""SELECT schema_name || '_t_' || ajzlx AS tableName, seq, c_stm, 0 AS data_state, '' AS row,
         concat_ws('|', 'c_baah=' || c_baah, 'c_stm=' || c_stm, 'd_xgsj=' || CASE WHEN seq % 97 = 3 THEN 'not a time'
           WHEN seq % 13 = 0 THEN '' ELSE CAST(date_trunc('second', apply_ts) AS VARCHAR) END, 'data_state=0', 'dbid=00',
           'dt=2024-02-01', 'extra=' || {EXTRA}, 'n_jbfy=' || CAST(n_jbfy AS VARCHAR), 'schemaName=' || schema_name,
           'tableName=' || schema_name || '_t_' || ajzlx, 'update_time=2024-02-01 00:00:00') AS body
    FROM ev WHERE data_state = 0"""

# per-event pulled rows of every record table, plus tombstones
REC = "rec AS (\n  " + "\n  UNION ALL\n  ".join([TOMBSTONES, *[_pulled(*s) for s in SOURCES]]) + ")"

COLS = """cols AS (SELECT * FROM (VALUES
 ('db_customer','t_customer','c_stm'), ('db_customer','t_customer','c_name'),
 ('db_customer','t_customer','n_nation'), ('db_customer','t_customer','c_mktsegment'),
 ('db_customer','t_customer_order','c_stm'), ('db_customer','t_customer_order','c_stm_customer'),
 ('db_customer','t_customer_order','o_orderstatus'), ('db_customer','t_customer_order','o_orderpriority'),
 ('db_customer','t_label','c_stm'), ('db_customer','t_label','n_quality'), ('db_customer','t_label','data_state'),
 ('db_customer','t_note','r_name'),
 ('db_customer','tab','c_stm'), ('db_customer','tab','n_name'),
 ('db_supplier','t_supplier','c_stm'), ('db_supplier','t_supplier','s_name'), ('db_supplier','t_supplier','n_nation'),
 ('db_supplier','t_lineitem','c_stm'), ('db_supplier','t_lineitem','c_stm_supplier'),
 ('db_supplier','t_lineitem','l_returnflag'), ('db_supplier','t_lineitem','l_linestatus'),
 ('db_fyygx','v_customer','c_stm_customer'), ('db_fyygx','v_customer','lang'),
 ('db_fyygx','v_customer','source'), ('db_fyygx','v_customer','n_chars')
) AS c(table_schema, table_name, column_name))"""

LISTED = """t AS (SELECT DISTINCT table_schema, table_name FROM cols
  WHERE table_name LIKE 't_%' AND table_schema IN (SELECT schema_name FROM pe))"""

GATED = """gated AS (
  SELECT * FROM ev e WHERE data_state IN (1, 2) AND (
    (schema_name = 'db_customer' AND (
        EXISTS (SELECT 1 FROM customer c WHERE CAST(c.c_custkey AS VARCHAR) = e.c_stm)
     OR EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_custkey AS VARCHAR) = e.c_stm)))
    OR (schema_name = 'db_supplier' AND
        EXISTS (SELECT 1 FROM supplier s WHERE CAST(s.s_suppkey AS VARCHAR) = e.c_stm))))"""

IE = """ie AS (
  SELECT 'index_00.t_' || ajzlx || '_index' AS index_table, c_stm, seq, data_state, d_xgsj, c_baah, n_jbfy, apply_ts
  FROM (SELECT * FROM ev WHERE data_state = 0 AND c_stm IS NOT NULL UNION ALL SELECT * FROM gated))"""

FOLD_SELECT = """
, a AS (
  SELECT index_table, c_stm,
         min(CASE WHEN data_state = 1 THEN seq END) AS first_ins,
         max(seq) AS last_seq,
         max(CASE WHEN data_state IN (1, 2) THEN seq END) AS attr_seq
  FROM ie GROUP BY index_table, c_stm)
SELECT a.index_table, a.c_stm, la.d_xgsj, la.c_baah, la.n_jbfy,
       fi.apply_ts AS create_time, le.apply_ts AS update_time, le.data_state
FROM a
JOIN ie fi ON fi.index_table = a.index_table AND fi.c_stm = a.c_stm AND fi.seq = a.first_ins
JOIN ie le ON le.index_table = a.index_table AND le.c_stm = a.c_stm AND le.seq = a.last_seq
JOIN ie la ON la.index_table = a.index_table AND la.c_stm = a.c_stm AND la.seq = a.attr_seq
WHERE a.first_ins IS NOT NULL"""


def _float_text(v: str, digits: int) -> str:
    """SQL of a float's text: DuckDB's shortest digits, without a point behind whole numbers, in exponent form from 10^digits."""
    t = f"regexp_replace(CAST({v} AS VARCHAR), '\\.0$', '')"
    body = f"regexp_replace(regexp_replace({t}, '^-', ''), '\\.', '')"
    exponent = f"(strlen(split_part(regexp_replace({t}, '^-', ''), '.', 1)) - 1)"
    mantissa = f"rtrim({body}, '0')"
    return f"""CASE WHEN isnan({v}) THEN 'NaN' WHEN isinf({v}) THEN CASE WHEN {v} < 0 THEN '-' ELSE '' END || 'Infinity'
        WHEN abs({v}) >= 1e{digits} AND NOT contains({t}, 'e') THEN CASE WHEN {v} < 0 THEN '-' ELSE '' END || left({mantissa}, 1)
             || CASE WHEN strlen({mantissa}) > 1 THEN '.' || substr({mantissa}, 2) ELSE '' END || 'e+' || lpad(CAST({exponent} AS VARCHAR), 2, '0')
        ELSE {t} END"""


_ODD = """CASE event_id % 5 WHEN 0 THEN 'NULL' WHEN 1 THEN 'a "b"\\c' WHEN 2 THEN '' WHEN 3 THEN 'x y' END"""
RECORD_TEXT = f"""SELECT CAST(event_id AS VARCHAR) AS c_stm, CASE WHEN event_id % 3 = 0 THEN 't' ELSE 'f' END AS b,
    CAST(event_id AS VARCHAR) AS i2, CAST(event_id AS VARCHAR) AS i4, CAST(CAST(value AS DECIMAL(20, 4)) AS VARCHAR) AS num,
    {_float_text("f", 15)} AS f8, {_float_text("w", 15)} AS f8_whole, {_float_text("CAST(event_id % 1000 / 8 AS FLOAT)", 6)} AS f4,
    strftime(ts, '%Y-%m-%d') AS d, regexp_replace(CAST(ts AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1') AS t,
    '\\x' || lower(hex(encode(CAST(user_id AS VARCHAR)))) AS raw,
    '{{' || event_id || ',' || CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'NULL' END || ',-1}}' AS ints,
    '{{' || event_type || ',' || CASE event_id % 5 WHEN 0 THEN '"NULL"' WHEN 1 THEN '"a \\"b\\"\\\\c"' WHEN 2 THEN '""'
        WHEN 3 THEN '"x y"' ELSE 'NULL' END || '}}' AS texts,
    CASE WHEN event_id % 2 = 0 THEN '{{t,NULL}}' ELSE '{{f,NULL}}' END AS flags,
    '(' || event_id || ',' || CASE WHEN event_id % 4 = 0 THEN '' ELSE CASE event_id % 5 WHEN 0 THEN 'NULL'
        WHEN 1 THEN '"a ""b""\\\\c"' WHEN 2 THEN '""' WHEN 3 THEN '"x y"' ELSE '' END END || ','
        || CASE WHEN event_id % 2 = 0 THEN 't' ELSE 'f' END || ')' AS pair,
    CASE WHEN event_id % 6 <> 0 THEN 'text' END AS s
  FROM (SELECT *, round(value, 2) * CASE event_id % 5 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1e-7 WHEN 2 THEN 1e12 WHEN 3 THEN 1e20
          ELSE -1e-3 END AS f, CASE event_id % 7 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE
          ELSE event_id::DOUBLE END AS w FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (CDC, EV, PULL_EV)
DT = "'2024-02-01'"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["decode_events"] = _with(CDC, EV) + \
        "SELECT seq, c_stm, d_xgsj, data_state, c_baah, n_jbfy, schema_name, ajzlx FROM ev"
    q["route_counts"] = _with(CDC, EV) + """SELECT schema_name,
        CASE WHEN data_state = 0 THEN 'tombstone' ELSE 'pull' END AS route, count(*) AS n
        FROM ev GROUP BY 1, 2"""
    q_quarantine = """SELECT seq,
        CASE seq % 97 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'no_data_state' WHEN 2 THEN 'bad_schema_name'
             WHEN 4 THEN 'bad_data_state' WHEN 5 THEN 'bad_n_jbfy' WHEN 6 THEN 'bad_json' ELSE 'bad_d_xgsj' END AS reason
        FROM cdc WHERE seq % 97 IN (0, 1, 2, 4, 5, 6) OR (seq % 97 = 3 AND data_state <> 0)"""
    q["quarantine"] = _with(CDC) + q_quarantine
    q["catalog_tables"] = _with(*BASE, COLS, LISTED) + "SELECT table_schema, table_name FROM t"
    q["catalog_key_shape"] = _with(*BASE, COLS, LISTED) + """
        , sk AS (SELECT table_schema, table_name FROM cols WHERE column_name LIKE 'c_stm%'
                 GROUP BY table_schema, table_name HAVING count(*) = 1)
        , s AS (SELECT t.table_schema, t.table_name, split_part(t.table_schema, '_', 2) AS ajzlx,
                       (sk.table_name IS NOT NULL) AS single_key
                FROM t LEFT JOIN sk ON sk.table_schema = t.table_schema AND sk.table_name = t.table_name)
        , k AS (SELECT *, CASE WHEN single_key THEN 'c_stm' ELSE 'c_stm_' || ajzlx END AS key_column FROM s)
        SELECT table_schema, table_name, ajzlx, single_key, key_column,
               EXISTS (SELECT 1 FROM cols c WHERE c.table_schema = k.table_schema AND c.table_name = k.table_name
                       AND c.column_name = k.key_column) AS key_present,
               split_part(table_name, '_', 2) <> '' AS routable,
               split_part(table_name, '_', 2) = ajzlx AS main_family
        FROM k"""
    q["fanout"] = _with(*BASE, COLS, LISTED) + """SELECT t.table_schema, t.table_name,
        count(*) AS n_events, count(DISTINCT e.c_stm) AS n_keys
        FROM pe e JOIN t ON e.schema_name = t.table_schema GROUP BY 1, 2"""
    q["target_names"] = _with(CDC, EV) + f"""SELECT seq,
        schema_name || '_t_' || ajzlx AS tombstone_table,
        schema_name || '_t_' || ajzlx || 'ws' AS view_table,
        'index_00.t_' || ajzlx || '_index' AS index_table, {DT} AS dt FROM ev"""
    q["end_to_end"] = _with(*BASE, REC) + \
        f"SELECT tableName, {DT} AS dt, count(*) AS n_records FROM rec GROUP BY tableName"
    q["bucket_counts"] = _with(*BASE, REC) + \
        f"SELECT 'db_ods15.db/' || tableName || '/dt=' || {DT} AS bucket, count(*) AS n_records FROM rec GROUP BY 1"
    q["compaction_rows"] = _with(*BASE, REC, "cut AS (SELECT max(event_id) // 2 AS half FROM events)") + f"""SELECT layout,
        tableName, {DT} AS dt, body, count(*) AS n_records, count(DISTINCT seq <= half) AS n_writers
        FROM rec, cut, (VALUES ('single'), ('per_table')) AS l(layout) GROUP BY ALL"""
    q["json_lines"] = _with(*BASE, REC) + \
        f"SELECT tableName, {DT} AS dt, body, count(*) AS copies FROM rec GROUP BY tableName, body"
    q["record_cols"] = _with(*BASE, REC) + "SELECT tableName, body, count(*) AS copies FROM rec GROUP BY tableName, body"
    q["target_names_zone"] = _with(CDC, EV) + """SELECT seq, schema_name || '_t_' || ajzlx AS tombstone_table,
        strftime(apply_ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt FROM ev"""
    clash = [("c_stm", "x.c_custkey"), ("seq", "x.c_name"), ("_k", "x.c_mktsegment"), ("_cnt", "x.c_nationkey"),
             ("_row", "'r' || x.c_mktsegment"), ("value", "'v' || x.c_mktsegment"), ("_c", "x.c_custkey")]
    q["clashing_columns"] = _with(*BASE) + f"""SELECT 'db_customer_t_customer' AS tableName, how, body, count(*) AS copies FROM (
        SELECT 'full' AS how, {_record("db_customer_t_customer", clash)} AS body FROM customer x
        UNION ALL SELECT 'keyed', {_record("db_customer_t_customer", clash)} FROM pe e
        JOIN customer x ON CAST(x.c_custkey AS VARCHAR) = e.c_stm WHERE e.schema_name = 'db_customer') GROUP BY ALL"""
    shared = _pulled("db_customer_t_customerws", "db_customer", "customer", "x.c_custkey",
                     [("c_stm", "x.c_custkey"), ("c_name", "x.c_name")])
    q["shared_record_table"] = _with(*BASE, REC) + f"""SELECT tableName, body, layout, count(*) AS copies FROM (
        SELECT tableName, body FROM rec WHERE tableName = 'db_customer_t_customerws'
        UNION ALL SELECT tableName, body FROM ({shared})), (VALUES ('single'), ('per_table')) AS l(layout) GROUP BY ALL"""
    pulls = _with(*BASE, REC) + "SELECT seq, tableName, c_stm, row FROM rec WHERE data_state = 1 AND tableName "
    q["pull_main"] = pulls + "IN ('db_customer_t_customer', 'db_supplier_t_supplier')"
    q["pull_child"] = pulls + "IN ('db_customer_t_customer_order', 'db_supplier_t_lineitem')"
    q["pull_irregular"] = pulls + "= 'db_customer_t_label'"
    q["pull_docview"] = _with(*BASE) + """SELECT e.seq, 'db_customer_t_customerws' AS tableName, e.c_stm,
        CAST(d.doc_id AS VARCHAR) AS c_stm_customer, d.lang, d.source, CAST(d.n_chars AS VARCHAR) AS n_chars
        FROM pe e JOIN documents d ON CAST(d.doc_id AS VARCHAR) = e.c_stm WHERE e.schema_name = 'db_customer'"""
    q["tombstones"] = _with(CDC, EV) + f"""SELECT seq, schema_name || '_t_' || ajzlx AS tableName,
        {DT} AS dt, '00' AS dbid, 0 AS data_state, 'BIGINT' AS data_state_type, c_stm,
        schema_name AS schemaName, c_baah, n_jbfy,
        CASE WHEN seq % 97 = 3 THEN 'not a time' WHEN seq % 13 = 0 THEN ''
             ELSE CAST(date_trunc('second', apply_ts) AS VARCHAR) END AS d_xgsj_text,
        '2024-02-01 00:00:00' AS update_time, {EXTRA} AS extra,
        concat_ws(',', CASE WHEN c_baah IS NOT NULL THEN 'c_baah' END, 'c_stm', 'd_xgsj', 'data_state', 'dbid',
                  'dt', CASE WHEN seq % 97 = 7 THEN 'extra' END, CASE WHEN n_jbfy IS NOT NULL THEN 'n_jbfy' END, 'schemaName', 'tableName',
                  'update_time') AS json_keys
        FROM ev WHERE data_state = 0"""
    q["alias_rule"] = """SELECT d.dbid, CAST(c.c_custkey AS VARCHAR) AS c_stm,
        CASE WHEN c.c_custkey % 3 <> 0 THEN c.c_mktsegment END AS n_jbfymc,
        CASE WHEN d.dbid IN ('6', '22') AND c.c_custkey % 3 <> 0 THEN c.c_mktsegment END AS c_jbfymc
        FROM customer c, (VALUES ('6'), ('0')) AS d(dbid)"""
    q["index_gate"] = _with(CDC, EV, GATED) + \
        "SELECT seq, 'index_00.t_' || ajzlx || '_index' AS index_table, c_stm, data_state FROM gated"
    q["index_fold"] = _with(CDC, EV, GATED, IE) + FOLD_SELECT
    q["index_merge"] = q["index_fold"]
    q["stream_index_replay"] = q["index_fold"]
    q["error_rows"] = _with(*BASE) + f"""
        SELECT '00' AS dbId, 'db_customer.t_note' AS tableName, c_stm,
               'source query failed: column c_stm_customer does not exist in db_customer.t_note' AS log_message,
               'increment' AS job_mode, {DT} AS c_dt, TIMESTAMP '2024-02-01 00:00:00' AS create_time, seq
        FROM pe WHERE schema_name = 'db_customer'
        UNION ALL
        SELECT '00', 'db_customer.tab', c_stm,
               'record conversion failed: table name tab has no case-type token',
               'increment', {DT}, TIMESTAMP '2024-02-01 00:00:00', seq
        FROM pe e WHERE schema_name = 'db_customer'
          AND EXISTS (SELECT 1 FROM nation n WHERE CAST(n.n_nationkey AS VARCHAR) = e.c_stm)"""
    name, _, _, _, fields = SOURCES[0]
    q["full_pull"] = f"""SELECT '{name}' AS tableName, {DT} AS dt, {_record(name, fields)} AS body,
        count(*) AS copies FROM customer x GROUP BY ALL"""
    index_line = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in (
        "c_stm", "d_xgsj", "c_baah", "n_jbfy", "create_time", "update_time", "data_state")) + ")"
    q["two_shard_batches"] = _with(*BASE, REC, GATED, IE) + "SELECT * FROM (" + f"""
        SELECT dbid, tableName AS name, replace(body, '|dbid=00|', '|dbid=' || dbid || '|') AS body, count(*) AS n
        FROM rec, (VALUES ('00'), ('06')) AS s(dbid) GROUP BY ALL
        UNION ALL
        SELECT dbid, replace(index_table, 'index_00', 'index_' || dbid) AS name, {index_line} AS body, 1 AS n
        FROM ({q["index_fold"]}), (VALUES ('00'), ('06')) AS s(dbid))"""
    q["index_partitioned"] = q["intake_bound"] = q["index_fold"]
    q["pull_wide"] = q["pull_bucketed"] = pulls + """IN ('db_customer_t_customer', 'db_customer_t_customer_order',
        'db_supplier_t_supplier', 'db_supplier_t_lineitem')"""
    q["catalog_session"] = f"""SELECT s.*, n.n_columns,
        CASE WHEN s.table_name IN ('t_customer_order', 't_lineitem') THEN 'BASE TABLE' ELSE 'VIEW' END AS table_type
        FROM ({q["catalog_key_shape"]}) s JOIN (SELECT table_schema, table_name, count(*) AS n_columns
              FROM (SELECT * FROM (WITH {COLS} SELECT * FROM cols)) GROUP BY ALL) n
        ON n.table_schema = s.table_schema AND n.table_name = s.table_name"""
    q["batch_metrics"] = _with(*BASE, REC, f"raw AS (SELECT seq, {RAW_VALUE_SQL} AS value FROM (SELECT seq, {PLAIN_VALUE_SQL} "
                               "AS plain FROM cdc))".replace("AS STRING", "AS VARCHAR"), f"bad AS ({q_quarantine})") + """
        SELECT 'events' AS kind, 'taken in' AS name, count(*) AS n FROM raw
        UNION ALL SELECT 'bytes', 'taken in', CAST(sum(strlen(value)) AS BIGINT) FROM raw
        UNION ALL SELECT 'reason', reason, count(*) FROM bad GROUP BY reason
        UNION ALL SELECT CASE WHEN data_state = 0 THEN 'tombstone' ELSE 'pull' END, schema_name, count(*) FROM ev GROUP BY ALL
        UNION ALL SELECT 'records', tableName, count(*) FROM rec GROUP BY tableName"""
    q["record_text"] = RECORD_TEXT
    return q
