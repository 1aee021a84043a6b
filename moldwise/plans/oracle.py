"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The fixture views of ``moldwise.sources.fixtures`` are restated as CTEs over
the pre-registered tables.  Doubles are rounded to ``DIGITS`` decimals on
both sides so engine-specific summation order cannot change a hash.
"""

from __future__ import annotations

DIGITS = 6

# Texts that DuckDB casts to a double but that are no plain numbers: with
# anything besides digits, signs, a point and an exponent letter, or with a
# digit separator.  Infinity is a number, NaN isn't.
INFINITY = "('inf', 'infinity', '+inf', '+infinity', '-inf', '-infinity')"


def _plain(x: str) -> str:
    return (f"((translate(lower({x}), '0123456789.+-e', '') = '' AND translate({x}, '.+-eE', '') <> '') "
            f"OR lower({x}) IN {INFINITY})")


def to_number(x: str) -> str:
    return f"(CASE WHEN {_plain(f'trim({x})')} THEN try_cast(trim({x}) AS DOUBLE) END)"


def _part(x: str, i: int) -> str:
    p = f"trim(string_split(trim({x}), ':')[{i}])"
    return f"(CASE WHEN {_plain(p)} THEN try_cast({p} AS DOUBLE) END)"


def duration(x: str) -> str:
    n = f"len(string_split(trim({x}), ':'))"
    return (f"(CASE WHEN {n} = 3 THEN {_part(x, 1)} * 3600 + {_part(x, 2)} * 60 + {_part(x, 3)} "
            f"WHEN {n} = 2 THEN {_part(x, 1)} * 60 + {_part(x, 2)} END)")


def rounded(sql: str, cols) -> str:
    """Wrap a query so the listed double columns are rounded."""
    if not cols:
        return sql
    rep = ", ".join(f'round("{c}", {DIGITS}) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _q"


_VAR = """CASE WHEN event_type = 'click' THEN 'Cushion'
            WHEN event_type = 'view' THEN 'Time_on_machine'
            WHEN event_type = 'signup' THEN 'Machine_status'
            WHEN event_type = 'purchase' THEN 'Shot_counter'
            WHEN event_type = 'error' AND k < 10 THEN 'Cyl_tmp_z2'
            WHEN event_type = 'error' THEN 'Cycle_time' END"""
_VAL = """CASE WHEN event_type = 'click' THEN CAST(value AS VARCHAR)
            WHEN event_type = 'view' THEN strftime(ts, '%H:%M:%S')
            WHEN event_type = 'signup' THEN '0' || chr(65 + k % 3) || '000'
            WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR)
            WHEN event_type = 'error' AND k < 10 THEN '0'
            WHEN event_type = 'error' THEN CAST(value AS VARCHAR) END"""

EV = "ev AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

READINGS = EV + f""",
readings AS (
  SELECT 'M' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '-10' AS machine_def,
         ts AS "timestamp", {_VAR} AS variable_name, {_VAL} AS value,
         CAST(NULL AS VARCHAR) AS variable_attribute
  FROM ev)"""

VREADINGS = EV + f""",
vreadings AS (
  SELECT strftime(ts, '%-m/%-d/%Y') AS date,
         'M' || CAST(100 + user_id % 900 AS VARCHAR) || '-11' AS machine_definition,
         {_VAR} AS variable_name, {_VAL} AS value
  FROM ev)"""

PRODUCTION = """production AS (
  SELECT o_orderkey AS order_id,
         'M-' || lpad(CAST(o_custkey % 20 AS VARCHAR), 5, '0') AS machine_id,
         'M-' || CAST(100 + o_custkey % 20 AS VARCHAR) AS machine_nr,
         strftime(DATE '2024-01-01' + CAST(o_orderkey % 40 AS INTEGER), '%d-%m-%Y') AS date,
         CAST(DATE '2024-01-01' + CAST(o_orderkey % 40 AS INTEGER) AS TIMESTAMP)
           + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_start,
         CAST(o_orderkey % 3 + 1 AS INTEGER) AS shift,
         o_orderpriority AS article, o_orderstatus AS order_status,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS actual_scrap_qty
  FROM orders)"""

HYDRA_RAW = """hydra_raw AS (
  SELECT CAST(l_shipdate AS DATE) AS date, 'M-' || CAST(l_suppkey AS VARCHAR) AS machine_nr,
         l_returnflag AS tool_number, l_linestatus AS article, l_quantity AS actual_scrap_qty
  FROM lineitem)"""

HYDRA_JAN = """hydra_jan AS (
  SELECT DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS date,
         'M-' || CAST(100 + o_custkey % 20 AS VARCHAR) AS machine_nr,
         'T' || CAST(o_custkey % 7 AS VARCHAR) AS tool_number,
         o_orderpriority AS article, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS actual_scrap_qty
  FROM orders)"""

DAILY = HYDRA_RAW + """,
daily AS (
  SELECT date, machine_nr AS machine_id, tool_number AS tool_id, article AS part_number,
         max(actual_scrap_qty) AS scrap_quantity
  FROM hydra_raw
  WHERE date IS NOT NULL AND machine_nr IS NOT NULL AND tool_number IS NOT NULL AND article IS NOT NULL
  GROUP BY ALL)"""

# Readings after parsing/classification, excluded variables removed.
PREP = READINGS + f""",
prep AS (
  SELECT machine_def, variable_name, value, "timestamp" AS tsp,
         strftime("timestamp", '%Y-%m-%d') AS agg_date,
         CASE WHEN variable_name = 'Time_on_machine' THEN {duration('value')}
              WHEN variable_name = 'Machine_status' THEN NULL
              ELSE {to_number('value')} END AS vn
  FROM readings
  WHERE variable_name NOT IN ('Cyl_tmp_z2', 'Cyl_tmp_z6', 'Cyl_tmp_z7', 'Switch_position'))"""

NUM_VARS = ["Cushion", "Cycle_time", "Time_on_machine"]
CAT_VARS = ["Machine_status"]
CNT_VARS = ["Shot_counter"]
FIXTURE_VARIABLES = sorted(NUM_VARS + CAT_VARS + CNT_VARS)


def _daily_features_sql(rounding: bool = True) -> str:
    sel, dbl = [], []
    for stat, fn in (("mean", "avg"), ("max", "max"), ("std", "stddev_samp"), ("count", "count")):
        for v in NUM_VARS:
            e = f"{fn}(vn) FILTER (WHERE variable_name = '{v}')"
            sel.append(f"{'nullif(' + e + ', 0)' if stat == 'count' else e} AS {v}_{stat}")
            if stat != "count":
                dbl.append(f"{v}_{stat}")
    for v in CNT_VARS:
        f = f"(variable_name = '{v}' AND vn IS NOT NULL)"
        sel.append(f"arg_min(vn, row(tsp, vn)) FILTER (WHERE {f}) AS {v}_first")
        sel.append(f"arg_max(vn, row(tsp, vn)) FILTER (WHERE {f}) AS {v}_last")
        sel.append(f"arg_max(vn, row(tsp, vn)) FILTER (WHERE {f}) - arg_min(vn, row(tsp, vn)) FILTER (WHERE {f}) AS {v}_delta")
        sel.append(f"nullif(count(vn) FILTER (WHERE {f}), 0) AS {v}_count")
        dbl += [f"{v}_first", f"{v}_last", f"{v}_delta"]
    modes = []
    for v in CAT_VARS:
        modes.append(f"""m_{v} AS (
  SELECT machine_def, agg_date, value AS {v}_mode FROM (
    SELECT machine_def, agg_date, value,
           row_number() OVER (PARTITION BY machine_def, agg_date ORDER BY count(*) DESC, value) AS rn
    FROM prep WHERE variable_name = '{v}' AND value IS NOT NULL
    GROUP BY machine_def, agg_date, value) WHERE rn = 1)""")
    joins = "".join(f" LEFT JOIN m_{v} USING (machine_def, agg_date)" for v in CAT_VARS)
    sql = f"""WITH {PREP},
usable AS (SELECT * FROM prep WHERE (variable_name = 'Machine_status' OR vn IS NOT NULL)
           AND machine_def IS NOT NULL AND agg_date IS NOT NULL),
agg AS (SELECT machine_def, agg_date, {', '.join(sel)} FROM usable GROUP BY machine_def, agg_date),
{', '.join(modes)}
SELECT * FROM agg{joins}"""
    return rounded(sql, dbl) if rounding else sql




def _daily_feature_doubles() -> list[str]:
    out = [f"{v}_{s}" for s in ("mean", "max", "std") for v in NUM_VARS]
    out += [f"{v}_{s}" for s in ("first", "last", "delta") for v in CNT_VARS]
    return out


def _features_cte() -> str:
    """``feats`` CTE (unrounded daily features) usable inside larger queries."""
    inner = _daily_features_sql(rounding=False)
    return f"feats AS ({inner})"


PROD_STD = """pstd AS (SELECT *, strftime(try_strptime(date, '%d-%m-%Y'), '%Y-%m-%d') AS date_key FROM production)"""

MAPPING = """pm AS (SELECT DISTINCT machine_id AS production_id,
                   replace(replace(machine_id, 'M-', ''), 'm-', '') AS core
            FROM production WHERE machine_id IS NOT NULL),
fm AS (SELECT replace(replace(split_part(machine_def, '-', 1), 'M', ''), 'm', '') AS core,
              min(machine_def) AS feature_id
       FROM feats WHERE machine_def IS NOT NULL GROUP BY 1),
mapping AS (SELECT production_id, feature_id FROM pm JOIN fm USING (core))"""

JOIN_SIDES = """pj AS (SELECT p.*, m.feature_id AS machine_key FROM pstd p LEFT JOIN mapping m ON p.machine_id = m.production_id),
fj AS (SELECT * EXCLUDE (machine_def, agg_date), machine_def AS machine_key, agg_date AS date_key FROM feats)"""


def _join_sql(how: str) -> str:
    sql = f"""WITH {PRODUCTION}, {_features_cte()}, {PROD_STD}, {MAPPING}, {JOIN_SIDES}
SELECT * FROM pj {how} JOIN fj USING (machine_key, date_key)"""
    return rounded(sql, _daily_feature_doubles())


def _join_report_sql() -> str:
    return f"""WITH {PRODUCTION}, {_features_cte()}, {PROD_STD}, {MAPPING}, {JOIN_SIDES},
l AS (SELECT pj.*, fj.machine_key IS NOT NULL AS matched FROM pj LEFT JOIN fj USING (machine_key, date_key)),
ov AS (SELECT count(*) AS n FROM (SELECT DISTINCT date_key FROM pstd WHERE date_key IS NOT NULL
                                  INTERSECT SELECT DISTINCT agg_date FROM feats WHERE agg_date IS NOT NULL)),
dj AS (SELECT count(*) AS n FROM (SELECT machine_key, date_key FROM l WHERE matched
                                  GROUP BY ALL HAVING count(*) > 1))
SELECT 'hydra_rows_before' AS metric, CAST(count(*) AS DOUBLE) AS value FROM l
UNION ALL SELECT 'target_non_null_before', count(actual_scrap_qty) FROM l
UNION ALL SELECT 'joined_rows', count(*) FROM l
UNION ALL SELECT 'matched_hydra_rows', count(*) FILTER (WHERE matched) FROM l
UNION ALL SELECT 'unmatched_hydra_rows', count(*) FILTER (WHERE NOT matched) FROM l
UNION ALL SELECT 'match_rate', round(count(*) FILTER (WHERE matched) / count(*), {DIGITS}) FROM l
UNION ALL SELECT 'target_non_null_after', count(actual_scrap_qty) FROM l
UNION ALL SELECT 'hydra_unique_dates', count(DISTINCT date_key) FROM pstd
UNION ALL SELECT 'param_rows_before', count(*) FROM feats
UNION ALL SELECT 'param_unique_dates', count(DISTINCT agg_date) FROM feats
UNION ALL SELECT 'duplicate_joins', n FROM dj
UNION ALL SELECT 'overlapping_dates', n FROM ov"""


def _date_overlap_sql() -> str:
    return f"""WITH {PRODUCTION}, {_features_cte()}, {PROD_STD},
a AS (SELECT DISTINCT date_key FROM pstd WHERE date_key IS NOT NULL),
b AS (SELECT DISTINCT agg_date AS date_key FROM feats WHERE agg_date IS NOT NULL)
SELECT coalesce(a.date_key, b.date_key) AS date_key,
       CASE WHEN a.date_key IS NOT NULL AND b.date_key IS NOT NULL THEN 'matched'
            WHEN a.date_key IS NOT NULL THEN 'unmatched' ELSE 'features_only' END AS status
FROM a FULL JOIN b ON a.date_key = b.date_key"""


def _key_diagnostics_sql() -> str:
    return f"""WITH {PRODUCTION}, {_features_cte()},
p AS (SELECT machine_id AS machine, count(*) AS rows,
             replace(replace(machine_id, 'M-', ''), 'm-', '') AS core FROM production GROUP BY machine_id),
f AS (SELECT machine_def AS machine, count(*) AS rows,
             replace(replace(split_part(machine_def, '-', 1), 'M', ''), 'm', '') AS core FROM feats GROUP BY machine_def)
SELECT 'production' AS side, machine, core, rows, core IN (SELECT core FROM f) AS matched FROM p
UNION ALL
SELECT 'features', machine, core, rows, core IN (SELECT core FROM p) FROM f"""


def _map_machines_sql() -> str:
    return f"""WITH {PRODUCTION}, {_features_cte()}, {MAPPING} SELECT production_id, feature_id FROM mapping"""


def _parse_values_sql() -> str:
    sql = f"""WITH {READINGS}
SELECT machine_def, "timestamp", variable_name, value,
       {to_number('value')} AS value_number,
       {duration('value')} AS value_seconds,
       CASE WHEN variable_name IN ('Cyl_tmp_z2', 'Cyl_tmp_z6', 'Cyl_tmp_z7', 'Switch_position') THEN 'excluded'
            WHEN variable_name = 'Time_on_machine' THEN 'time_duration'
            WHEN variable_name = 'Machine_status' THEN 'categorical'
            WHEN variable_name IN ('Shot_counter', 'Scrap_counter') THEN 'counters'
            ELSE 'numeric' END AS var_class
FROM readings"""
    return rounded(sql, ["value_number", "value_seconds"])


def _hyphen(x: str) -> str:
    r = f"replace({x}, 'M', 'M-')"
    return (f"(CASE WHEN starts_with({x}, 'M') AND NOT contains(substr({x}, 1, 2), '-') "
            f"THEN split_part({r}, '-', 1) || '-' || split_part({r}, '-', 2) ELSE {x} END)")


def _digits3(x: str) -> str:
    d = f"regexp_extract({x}, '(\\d{{3}})', 1)"
    return f"(CASE WHEN {x} IS NOT NULL AND {d} <> '' THEN 'M' || {d} ELSE 'Unknown' END)"


def _machine_keys_sql() -> str:
    path = "'/data/raw_param/' || machine_definition || '_Jan.csv'"
    d = f"regexp_extract({path}, '(?i)M[-_\\s]?(\\d{{3}})', 1)"
    return f"""WITH {VREADINGS}
SELECT machine_definition,
       regexp_replace(machine_definition, '[- ]', '', 'g') AS key_strip,
       {_digits3('machine_definition')} AS key_digits3,
       {_hyphen('machine_definition')} AS key_hyphen,
       replace(replace(split_part(machine_definition, '-', 1), 'M', ''), 'm', '') AS key_core,
       CASE WHEN {d} <> '' THEN 'M-' || {d} ELSE 'Unknown' END AS key_from_path
FROM vreadings"""


def _standardize_date_sql() -> str:
    return f"""WITH {PRODUCTION}
SELECT order_id, date, strftime(try_strptime(date, '%d-%m-%Y'), '%Y-%m-%d') AS date_key FROM production"""


def _classify_sql() -> str:
    return f"""WITH {READINGS}
SELECT DISTINCT variable_name,
       CASE WHEN variable_name IN ('Cyl_tmp_z2', 'Cyl_tmp_z6', 'Cyl_tmp_z7', 'Switch_position') THEN 'excluded'
            WHEN variable_name = 'Time_on_machine' THEN 'time_duration'
            WHEN variable_name = 'Machine_status' THEN 'categorical'
            WHEN variable_name IN ('Shot_counter', 'Scrap_counter') THEN 'counters'
            ELSE 'numeric' END AS var_class
FROM readings WHERE variable_name IS NOT NULL"""


def _dedupe_sql() -> str:
    return """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate
         ORDER BY o_orderkey NULLS FIRST, o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST,
                  o_orderpriority NULLS FIRST) AS rn
  FROM orders) WHERE rn = 1"""


VERT_VARS = ["Cushion", "Cycle_time", "Cyl_tmp_z2", "Shot_counter"]

VNUM = VREADINGS + f""",
vnum AS (SELECT {_digits3('machine_definition')} AS machine_id,
                CAST(try_strptime(date, '%m/%d/%Y') AS DATE) AS date,
                {_hyphen('machine_definition')} AS machine_hyphen,
                variable_name, {to_number('value')} AS v
         FROM vreadings)"""


def _vertical_features_body() -> tuple[str, list[str]]:
    sel, dbl = [], []
    for stat, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
        for v in VERT_VARS:
            sel.append(f"{fn}(v) FILTER (WHERE variable_name = '{v}') AS {v}_{stat}")
            dbl.append(f"{v}_{stat}")
    body = f"""SELECT machine_id, date, {', '.join(sel)} FROM vnum
WHERE v IS NOT NULL AND machine_id IS NOT NULL AND date IS NOT NULL GROUP BY machine_id, date"""
    return body, dbl


def _vertical_features_sql() -> str:
    body, dbl = _vertical_features_body()
    return rounded(f"WITH {VNUM} {body}", dbl)


def _join_vertical_sql() -> str:
    body, dbl = _vertical_features_body()
    sql = f"""WITH {PRODUCTION}, {VNUM}, vf AS ({body}),
pv AS (SELECT * REPLACE ({_digits3('machine_nr')} AS machine_id, CAST(order_start AS DATE) AS date) FROM production)
SELECT * FROM pv JOIN vf USING (machine_id, date)"""
    return rounded(sql, dbl)


def _sensor_means_body() -> str:
    sel = ", ".join(f"avg(v) FILTER (WHERE variable_name = '{v}') AS {v}" for v in VERT_VARS)
    return f"""SELECT date, machine_hyphen AS machine_id, {sel} FROM vnum
WHERE v IS NOT NULL AND machine_hyphen IS NOT NULL AND date IS NOT NULL GROUP BY date, machine_hyphen"""


def _sensor_means_sql() -> str:
    return rounded(f"WITH {VNUM} {_sensor_means_body()}", VERT_VARS)


DAILY_JAN = HYDRA_JAN + """,
daily_jan AS (
  SELECT date, machine_nr AS machine_id, tool_number AS tool_id, article AS part_number,
         max(actual_scrap_qty) AS scrap_quantity
  FROM hydra_jan
  WHERE date IS NOT NULL AND machine_nr IS NOT NULL AND tool_number IS NOT NULL AND article IS NOT NULL
  GROUP BY ALL)"""


def _sensor_training_sql() -> str:
    fill = ", ".join(f"coalesce(m.{v}, 0) AS {v}" for v in VERT_VARS)
    sql = f"""WITH {VNUM}, sm AS ({_sensor_means_body()}), {DAILY_JAN}
SELECT d.date, d.machine_id, d.tool_id, d.part_number, coalesce(d.scrap_quantity, 0) AS scrap_quantity, {fill}
FROM daily_jan d JOIN sm m ON d.date = m.date AND d.machine_id = m.machine_id"""
    return rounded(sql, VERT_VARS + ["scrap_quantity"])


def _union_sql() -> str:
    fill = ", ".join(f"coalesce(m.{v}, 0) AS {v}" for v in VERT_VARS)
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {v}" for v in VERT_VARS)
    sql = f"""WITH {VNUM}, sm AS ({_sensor_means_body()}), {DAILY_JAN}, {DAILY}
SELECT date, machine_id, tool_id, part_number, scrap_quantity, 'lineitem' AS source, {nulls} FROM daily
UNION ALL
SELECT d.date, d.machine_id, d.tool_id, d.part_number, coalesce(d.scrap_quantity, 0), NULL, {fill}
FROM daily_jan d JOIN sm m ON d.date = m.date AND d.machine_id = m.machine_id"""
    return rounded(sql, VERT_VARS + ["scrap_quantity"])


def _daily_scrap_sql() -> str:
    return rounded(f"WITH {DAILY} SELECT * FROM daily", ["scrap_quantity"])


def queries_sql() -> dict[str, str]:
    return {
        "daily_features": _daily_features_sql(),
        "parse_values": _parse_values_sql(),
        "machine_keys": _machine_keys_sql(),
        "standardize_date": _standardize_date_sql(),
        "classify_variables": _classify_sql(),
        "map_machines": _map_machines_sql(),
        "dedupe_keys": _dedupe_sql(),
        "join_left": _join_sql("LEFT"),
        "join_inner": _join_sql("INNER"),
        "join_report": _join_report_sql(),
        "date_overlap": _date_overlap_sql(),
        "key_diagnostics": _key_diagnostics_sql(),
        "vertical_features": _vertical_features_sql(),
        "join_vertical": _join_vertical_sql(),
        "sensor_means": _sensor_means_sql(),
        "sensor_training_set": _sensor_training_sql(),
        "union_datasets": _union_sql(),
        "daily_scrap": _daily_scrap_sql(),
        **_window_queries(),
        **_quality_queries(),
        **_summary_queries(),
        **_selection_queries(),
        **_source_queries(),
        **_missing_queries(),
        **_stream_queries(),
        **_extra_queries(),
        **_model_queries(),
        **_stored_queries(),
    }


KEYS = "machine_id, tool_id, part_number"

LAGGED = DAILY + f""",
lf AS (
  SELECT *, lag(scrap_quantity, 1) OVER (PARTITION BY {KEYS} ORDER BY date) AS scrap_lag_1,
         lag(scrap_quantity, 2) OVER (PARTITION BY {KEYS} ORDER BY date) AS scrap_lag_2,
         CASE WHEN count(scrap_quantity) OVER (PARTITION BY {KEYS} ORDER BY date
                                               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
              THEN avg(scrap_quantity) OVER (PARTITION BY {KEYS} ORDER BY date
                                             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS rolling_avg_3
  FROM daily),
clean AS (SELECT * FROM lf WHERE date IS NOT NULL AND machine_id IS NOT NULL AND tool_id IS NOT NULL
          AND part_number IS NOT NULL AND scrap_quantity IS NOT NULL AND scrap_lag_1 IS NOT NULL
          AND scrap_lag_2 IS NOT NULL AND rolling_avg_3 IS NOT NULL),
ff AS (SELECT *, CAST(dense_rank() OVER (ORDER BY machine_id) - 1 AS INTEGER) AS machine_code,
              CAST(dense_rank() OVER (ORDER BY tool_id) - 1 AS INTEGER) AS tool_code,
              CAST(dense_rank() OVER (ORDER BY part_number) - 1 AS INTEGER) AS part_code
       FROM clean)"""

LAG_DOUBLES = ["scrap_quantity", "scrap_lag_1", "scrap_lag_2", "rolling_avg_3"]


def _lag_features_sql() -> str:
    return rounded(f"WITH {LAGGED} SELECT * FROM ff", LAG_DOUBLES)


def _time_split_sql() -> str:
    sql = f"""WITH {LAGGED},
d AS (SELECT DISTINCT date FROM ff WHERE date IS NOT NULL),
n AS (SELECT count(*) AS n, greatest(CAST(floor(count(*) * 0.8) AS BIGINT), 1) AS k FROM d),
cut AS (SELECT date AS cut FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i FROM d), n WHERE i = n.k)
SELECT ff.*, CASE WHEN n.k >= n.n THEN 'train' WHEN ff.date < cut.cut THEN 'train'
                  WHEN ff.date >= cut.cut THEN 'test' END AS split
FROM ff, n LEFT JOIN cut ON TRUE"""
    return rounded(sql, LAG_DOUBLES)


def _scoring_context_sql() -> str:
    sql = f"""WITH {DAILY},
r AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY date DESC) AS rn FROM daily)
SELECT {KEYS}, max(scrap_quantity) FILTER (WHERE rn = 1) AS scrap_lag_1,
       max(scrap_quantity) FILTER (WHERE rn = 2) AS scrap_lag_2,
       avg(scrap_quantity) AS rolling_avg_3,
       max(date) FILTER (WHERE rn = 1) AS last_date,
       CAST(max(date) FILTER (WHERE rn = 1) + INTERVAL 1 DAY AS DATE) AS forecast_date
FROM r WHERE rn <= 3 GROUP BY {KEYS} HAVING count(*) >= 3"""
    return rounded(sql, ["scrap_lag_1", "scrap_lag_2", "rolling_avg_3"])


def _most_active_sql() -> str:
    return f"""WITH {DAILY}
SELECT {KEYS}, count(*) AS rows FROM daily GROUP BY {KEYS} ORDER BY rows DESC, {KEYS} LIMIT 1"""


def _planning_kpis_sql() -> str:
    sql = f"""WITH {DAILY}
SELECT {KEYS}, avg(scrap_quantity) AS avg_scrap_24h, avg(scrap_quantity) / 2 AS avg_scrap_12h,
       max(scrap_quantity) AS max_scrap, count(scrap_quantity) AS days
FROM daily GROUP BY {KEYS}"""
    return rounded(sql, ["avg_scrap_24h", "avg_scrap_12h", "max_scrap"])


def _job_combinations_sql() -> str:
    return f"""WITH {DAILY} SELECT DISTINCT {KEYS} FROM daily"""


def _label_encode_sql() -> str:
    sql = f"""WITH {LAGGED}, {DAILY_JAN},
codes AS (SELECT DISTINCT machine_id, machine_code FROM ff)
SELECT d.*, coalesce(c.machine_code, 0) AS machine_code FROM daily_jan d LEFT JOIN codes c USING (machine_id)"""
    return rounded(sql, ["scrap_quantity"])


def _window_queries() -> dict[str, str]:
    return {
        "lag_features": _lag_features_sql(),
        "time_split": _time_split_sql(),
        "scoring_context": _scoring_context_sql(),
        "most_active_job": _most_active_sql(),
        "planning_kpis": _planning_kpis_sql(),
        "job_combinations": _job_combinations_sql(),
        "label_encode": _label_encode_sql(),
    }


# ------------------------------------------------------------------ quality --
CUST_GAPS = """cg AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name,
         CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS c_nationkey,
         CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 50 <> 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer)"""

ORDER_FACTS = "ofacts AS (SELECT o_custkey, o_orderdate, o_orderstatus, o_orderpriority FROM orders)"

ISSUE_COLS = "dataset, \"column\", issue_type, severity, message, count, pct"


def pct1(m: str, n: str) -> str:
    t = f"(({m}) * 2000 + ({n})) // (({n}) * 2)"
    return f"(CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR))"


def thousands(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _missing_sql(table: str, cols: list[tuple[str, bool]], dataset: str, warn=5.0, err=50.0) -> str:
    parts = []
    for c, is_double in cols:
        cond = f"({c} IS NULL OR isnan({c}))" if is_double else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {cond}) AS m, count(*) AS n FROM {table}")
    body = " UNION ALL ".join(parts)
    pct = "(m * 100.0 / n)"
    return f"""SELECT '{dataset}' AS dataset, "column", 'missing_values' AS issue_type,
  CASE WHEN {pct} > {err} THEN 'error' WHEN {pct} > {warn} THEN 'warning' ELSE 'info' END AS severity,
  {thousands('m')} || ' values missing, ' || {pct1('m', 'n')} || '% of the rows' AS message,
  CAST(m AS BIGINT) AS count, round({pct}, {DIGITS}) AS pct
FROM ({body}) WHERE n > 0 AND m > 0"""


def _dup_sql(table: str, cols: list[str], keys: list[str], dataset: str, max_pct=5.0) -> str:
    allc = ", ".join(cols)
    pct = "(dup * 100.0 / n)"
    sql = f"""SELECT '{dataset}' AS dataset, CAST(NULL AS VARCHAR) AS "column", 'duplicates' AS issue_type,
  CASE WHEN {pct} > {max_pct} THEN 'error' ELSE 'warning' END AS severity,
  {thousands('dup')} || ' rows repeat an earlier one, ' || {pct1('dup', 'n')} || '% of the rows' AS message,
  CAST(dup AS BIGINT) AS count, round({pct}, {DIGITS}) AS pct
FROM (SELECT sum(c) AS n, sum(c - 1) AS dup FROM (SELECT count(*) AS c FROM {table} GROUP BY ALL_COLS))
WHERE dup > 0""".replace("GROUP BY ALL_COLS", f"GROUP BY {allc}")
    if keys:
        k = ", ".join(keys)
        sql += f"""
UNION ALL
SELECT '{dataset}', NULL, 'duplicate_keys', 'warning',
  {thousands('dup')} || ' rows repeat a key of ({k}), ' || {pct1('dup', 'n')} || '% of the rows',
  CAST(dup AS BIGINT), round({pct}, {DIGITS})
FROM (SELECT sum(c) AS n, sum(c - 1) AS dup FROM (SELECT count(*) AS c FROM {table} GROUP BY {k})) WHERE dup > 0"""
    return sql


def _range_sql(table: str, col: str, lo, hi, dataset: str) -> str:
    parts = []
    if lo is not None:
        parts.append(f"""SELECT '{dataset}' AS dataset, '{col}' AS "column", 'out_of_range' AS issue_type,
  'error' AS severity, {thousands('k')} || ' values below the lower bound {float(lo)}' AS message,
  CAST(k AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS pct
FROM (SELECT count(*) FILTER (WHERE {col} < {lo}) AS k FROM {table}) WHERE k > 0""")
    if hi is not None:
        parts.append(f"""SELECT '{dataset}', '{col}', 'out_of_range', 'error',
  {thousands('k')} || ' values above the upper bound {float(hi)}', CAST(k AS BIGINT), CAST(NULL AS DOUBLE)
FROM (SELECT count(*) FILTER (WHERE {col} > {hi}) AS k FROM {table}) WHERE k > 0""")
    return " UNION ALL ".join(parts)


def _outlier_sql(table: str, col: str, mult: float, dataset: str) -> str:
    pct = "(k * 100.0 / n)"
    return f"""SELECT '{dataset}' AS dataset, '{col}' AS "column", 'outliers' AS issue_type,
  CASE WHEN {pct} < 5 THEN 'warning' ELSE 'error' END AS severity,
  {thousands('k')} || ' values outside the quartile fences (' || {pct1('k', 'n')} || '% of all)' AS message,
  CAST(k AS BIGINT) AS count, round({pct}, {DIGITS}) AS pct
FROM (SELECT count(*) FILTER (WHERE {col} < q1 - {mult} * (q3 - q1) OR {col} > q3 + {mult} * (q3 - q1)) AS k,
             count({col}) AS n
      FROM {table}, (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3,
                            count({col}) AS nn FROM {table}) q
      WHERE q.nn >= 4)
WHERE k > 0"""


def _min_rows_sql(table: str, dataset: str, min_rows: int = 100) -> str:
    return f"""SELECT '{dataset}' AS dataset, CAST(NULL AS VARCHAR) AS "column", 'insufficient_data' AS issue_type,
  'critical' AS severity, CAST(n AS VARCHAR) || ' rows are fewer than the {min_rows} needed' AS message,
  CAST(n AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS pct
FROM (SELECT count(*) AS n FROM {table}) WHERE n < {min_rows}"""


PROD_COLS = [("order_id", False), ("machine_id", False), ("machine_nr", False), ("date", False),
             ("order_start", False), ("shift", False), ("article", False), ("order_status", False),
             ("actual_scrap_qty", False)]
READING_COLS = [("machine_def", False), ("timestamp", False), ("variable_name", False), ("value", False),
                ("variable_attribute", False)]


def _validate_production_body() -> str:
    return " UNION ALL ".join([
        _min_rows_sql("production", "HydraData"),
        _range_sql("production", "actual_scrap_qty", 0.0, None, "HydraData"),
        _outlier_sql("production", "actual_scrap_qty", 1.5, "HydraData"),
        _missing_sql("production", PROD_COLS, "HydraData"),
        _dup_sql("production", [c for c, _ in PROD_COLS], ["machine_id", "date"], "HydraData"),
    ])


def _quality_queries() -> dict[str, str]:
    cust = [("c_custkey", False), ("c_name", False), ("c_nationkey", False), ("c_acctbal", True),
            ("c_mktsegment", False)]
    return {
        "check_missing": f"WITH {CUST_GAPS} " + _missing_sql("cg", cust, "customer"),
        "check_duplicates": f"WITH {ORDER_FACTS} " + _dup_sql(
            "ofacts", ["o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"],
            ["o_custkey", "o_orderdate"], "orders"),
        "check_ranges": _range_sql("customer", "c_acctbal", 0.0, 9000.0, "customer"),
        "check_outliers_iqr": _outlier_sql("orders", "o_totalprice", 1.5, "orders"),
        "validate_production": f"WITH {PRODUCTION} " + _validate_production_body(),
        "validate_readings": f"WITH {READINGS} " + " UNION ALL ".join([
            _min_rows_sql("readings", "ParamData"),
            _missing_sql("readings", READING_COLS, "ParamData"),
            _dup_sql("readings", [c for c, _ in READING_COLS], [], "ParamData"),
            f"""SELECT 'ParamData', 'variable_name', 'sparse_data', 'info',
  CAST(k AS VARCHAR) || ' variables with under 10 readings', CAST(k AS BIGINT), CAST(NULL AS DOUBLE)
FROM (SELECT count(*) AS k FROM (SELECT variable_name FROM readings WHERE variable_name IS NOT NULL
      GROUP BY variable_name HAVING count(*) < 10)) WHERE k > 0"""]),
        "validation_report": f"""WITH {PRODUCTION}, issues AS ({_validate_production_body()})
SELECT 'HydraData' AS dataset, (SELECT count(*) FROM production) AS row_count, 9 AS column_count,
  count(*) FILTER (WHERE severity = 'critical') AS critical_count,
  count(*) FILTER (WHERE severity = 'error') AS error_count,
  count(*) FILTER (WHERE severity = 'warning') AS warning_count,
  count(*) FILTER (WHERE severity = 'info') AS info_count,
  count(*) AS issue_count,
  count(*) FILTER (WHERE severity IN ('critical', 'error')) = 0 AS is_valid
FROM issues""",
    }


# ---------------------------------------------------------------- summaries --
def _r(x: str) -> str:
    return f"round({x}, {DIGITS})"


def _span(lo: str, hi: str) -> str:
    return f"date_diff('second', {lo}, {hi})"


READING_NAMES = [c for c, _ in READING_COLS]
PROD_TYPES = [("order_id", "bigint"), ("machine_id", "string"), ("machine_nr", "string"), ("date", "string"),
              ("order_start", "timestamp_ntz"), ("shift", "int"), ("article", "string"),
              ("order_status", "string"), ("actual_scrap_qty", "bigint")]
PROD_NUMERIC = {"order_id", "shift", "actual_scrap_qty"}


def _feature_names() -> list[str]:
    out = [f"{v}_{s}" for s in ("mean", "max", "std", "count") for v in NUM_VARS]
    out += [f"{v}_mode" for v in CAT_VARS]
    out += [f"{v}_{s}" for s in ("first", "last", "delta", "count") for v in CNT_VARS]
    return out


def _summary_queries() -> dict[str, str]:
    num = to_number("value")
    q = {}
    q["profile_readings"] = f"""WITH {READINGS}
SELECT count(*) AS rows, count(DISTINCT variable_name) AS variables,
  min("timestamp") AS ts_min, max("timestamp") AS ts_max,
  count(*) FILTER (WHERE "timestamp" IS NULL) AS bad_timestamps,
  CAST(floor({_span('min("timestamp")', 'max("timestamp")')} / 86400) AS BIGINT) AS span_days,
  CAST(floor(({_span('min("timestamp")', 'max("timestamp")')} % 86400) / 3600) AS BIGINT) AS span_hours,
  count({num}) AS numeric_values, count(*) - count({num}) AS non_numeric_values,
  {_r(f'count({num}) * 100.0 / count(*)')} AS numeric_pct
FROM readings"""
    q["column_missing"] = f"WITH {READINGS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS missing,
  {_r(f'count(*) FILTER (WHERE "{c}" IS NULL) * 100.0 / count(*)')} AS missing_pct FROM readings"""
        for c in READING_NAMES)
    q["profile_variables"] = f"""WITH {READINGS}
SELECT variable_name AS variable, count(v) AS n, {_r('avg(v)')} AS mean, {_r('stddev_samp(v)')} AS std,
  {_r('min(v)')} AS min, {_r('max(v)')} AS max
FROM (SELECT variable_name, {num} AS v FROM readings) WHERE v IS NOT NULL GROUP BY variable_name"""
    q["top_values"] = f"""WITH {READINGS},
c AS (SELECT value, count(*) AS count FROM readings WHERE value IS NOT NULL GROUP BY value
      ORDER BY count DESC, value LIMIT 10)
SELECT value, count, {_r('count * 100.0 / (SELECT count(*) FROM readings)')} AS pct,
  row_number() OVER (ORDER BY count DESC, value) AS rank FROM c"""
    q["value_type_profile"] = f"""WITH {READINGS},
base AS (SELECT variable_name AS variable, value, {num} IS NULL AS nn FROM readings),
c AS (SELECT variable, count(*) FILTER (WHERE nn) AS non_numeric, count(*) AS total FROM base GROUP BY variable),
d AS (SELECT DISTINCT variable, value FROM base WHERE nn),
r AS (SELECT variable, coalesce(value, '<null>') AS v,
             row_number() OVER (PARTITION BY variable ORDER BY value NULLS FIRST) AS rn FROM d),
s AS (SELECT variable, string_agg(v, ', ' ORDER BY v) AS samples FROM r WHERE rn <= 3 GROUP BY variable)
SELECT c.variable, c.total, c.non_numeric, s.samples FROM c LEFT JOIN s ON c.variable = s.variable
WHERE c.non_numeric > 0"""
    q["machine_comparison"] = f"""WITH {READINGS}
SELECT machine_def AS machine, count(*) AS rows, count(DISTINCT variable_name) AS variables,
  CAST(min("timestamp") AS DATE) AS first_date, CAST(max("timestamp") AS DATE) AS last_date,
  CAST(floor({_span('min("timestamp")', 'max("timestamp")')} / 86400) AS BIGINT) AS days,
  {_r(f'count({num}) * 100.0 / count(*)')} AS numeric_pct
FROM readings GROUP BY machine_def"""
    parts = []
    for c, t in PROD_TYPES:
        if c in PROD_NUMERIC:
            x = f"CAST({c} AS DOUBLE)"
            parts.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, {_r(f'avg({x})')} AS mean,
  {_r(f'stddev_samp({x})')} AS std, {_r(f'min({x})')} AS min, {_r(f'max({x})')} AS max,
  CAST(NULL AS BIGINT) AS unique_count, CAST(NULL AS VARCHAR) AS top_values FROM production""")
        else:
            parts.append(f"""SELECT '{c}', '{t}', NULL, NULL, NULL, NULL,
  (SELECT count(DISTINCT {c}) FROM production),
  (SELECT string_agg(v || ':' || CAST(n AS VARCHAR), '|' ORDER BY n DESC, v)
   FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM production WHERE {c} IS NOT NULL
         GROUP BY 1 ORDER BY n DESC, v LIMIT 5))""")
    q["column_stats"] = f"WITH {PRODUCTION} " + " UNION ALL ".join(parts)
    q["cumulative_verdict"] = f"WITH {PRODUCTION} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_r(f'avg({c})')} AS average, {_r(f'CAST(max({c}) AS DOUBLE)')} AS maximum,
  CASE WHEN avg({c}) > 10000 THEN 'cumulative' ELSE 'daily' END AS verdict FROM production"""
        for c in ("actual_scrap_qty", "order_id"))
    feats = _feature_names()
    nulls = " + ".join(f'count(*) FILTER (WHERE "{f}" IS NULL)' for f in feats)
    anyf = "coalesce(" + ", ".join(f'CAST("{f}" AS VARCHAR)' for f in feats) + ") IS NOT NULL"
    q["dataset_summary"] = f"""WITH {PRODUCTION}, {_features_cte()}, {PROD_STD}, {MAPPING}, {JOIN_SIDES},
ml AS (SELECT * FROM pj LEFT JOIN fj USING (machine_key, date_key))
SELECT {9 + 2 + len(feats)} AS total_columns, {len(feats)} AS feature_columns,
  count(*) AS total_rows, count(actual_scrap_qty) AS target_count, {_r('avg(actual_scrap_qty)')} AS target_mean,
  {_r('stddev_samp(actual_scrap_qty)')} AS target_std, {_r('CAST(min(actual_scrap_qty) AS DOUBLE)')} AS target_min,
  {_r('CAST(max(actual_scrap_qty) AS DOUBLE)')} AS target_max,
  count(*) FILTER (WHERE actual_scrap_qty = 0) AS target_zeros,
  count(*) FILTER (WHERE actual_scrap_qty > 0) AS target_non_zeros,
  {_r(f'({nulls}) * 100.0 / (count(*) * {len(feats)})')} AS feature_missing_pct,
  count(*) FILTER (WHERE {anyf}) AS rows_with_features,
  count(*) FILTER (WHERE NOT ({anyf})) AS rows_without_features,
  count(DISTINCT machine_id) AS unique_machines, count(DISTINCT date_key) AS unique_dates
FROM ml"""
    fcols = ["machine_def", "agg_date"] + feats
    kinds = ("mean", "max", "std", "count", "mode", "delta")

    def kind(c):
        for k in kinds:
            if c.endswith(f"_{k}"):
                return f"'{k}'"
        return "CAST(NULL AS VARCHAR)"
    counts = ", ".join(f"{len([c for c in fcols if c.endswith('_' + k)])} AS {k}_features" for k in kinds)
    q["feature_summary"] = f"""WITH {_features_cte()},
n AS (SELECT count(*) AS n FROM feats),
m AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, {kind(c)} AS kind, count(*) FILTER (WHERE \"{c}\" IS NULL) AS k FROM feats" for c in fcols)})
SELECT m.col AS "column", m.kind, CASE WHEN n.n > 0 THEN ((m.k * 20000 + n.n) // (n.n * 2)) / 100 END AS missing_pct,
  n.n AS rows, {len(fcols)} AS columns, {counts}
FROM m, n"""
    rk = ("mean", "max", "std", "count", "delta", "first", "last")
    rcols = [c for c in fcols if c != "Machine_status_mode" and any(c.endswith(f"_{k}") for k in rk)]
    q["feature_ranges"] = f"WITH {_features_cte()} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{c.rsplit('_', 1)[1]}' AS kind, {_r(f'CAST(min("{c}") AS DOUBLE)')} AS min,
  {_r(f'CAST(max("{c}") AS DOUBLE)')} AS max FROM feats""" for c in rcols)
    return q


# ------------------------------------------- selection, splits and metrics --
ML = f"""{PRODUCTION}, {_features_cte()}, {PROD_STD}, {MAPPING}, {JOIN_SIDES},
ml AS (SELECT * FROM pj LEFT JOIN fj USING (machine_key, date_key))"""

ML_FEATURES = sorted(["order_id", "shift"] + [f for f in _feature_names() if not f.endswith("_mode")])
ML_GAPS = [f for f in ML_FEATURES if f not in ("order_id", "shift")]


def _gkey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in cols)
    return f"md5(concat_ws('_', {parts}) || '#42')"


RISK = """thr AS (SELECT quantile_cont(actual_scrap_qty, 0.75) AS t FROM production),
lab AS (SELECT p.*, coalesce(CAST(p.actual_scrap_qty > thr.t AS INTEGER), 0) AS high_scrap_risk
        FROM production p, thr)"""


def _split_cte(src: str, key: str, name: str) -> str:
    return f"""{name}_g AS (SELECT DISTINCT {key} AS h FROM {src}),
{name}_c AS (SELECT h FROM (SELECT h, row_number() OVER (ORDER BY h) AS i FROM {name}_g)
             WHERE i = (SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) FROM {name}_g)),
{name} AS (SELECT *, CASE WHEN {key} <= (SELECT h FROM {name}_c) THEN 'test' ELSE 'train' END AS split FROM {src})"""


PERSIST = f"""{LAGGED},
d AS (SELECT DISTINCT date FROM ff WHERE date IS NOT NULL),
n AS (SELECT count(*) AS n, greatest(CAST(floor(count(*) * 0.8) AS BIGINT), 1) AS k FROM d),
cut AS (SELECT date AS cut FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i FROM d), n WHERE i = n.k),
ts AS (SELECT ff.* FROM ff, n, cut WHERE n.k < n.n AND ff.date >= cut.cut),
pt AS (SELECT quantile_cont(scrap_quantity, 0.75) AS t FROM ts),
pc AS (SELECT CAST(scrap_quantity > pt.t AS INTEGER) AS actual_high, CAST(scrap_lag_1 > pt.t AS INTEGER) AS predicted_high
       FROM ts, pt),
cls AS (SELECT DISTINCT c FROM (SELECT actual_high AS c FROM pc UNION ALL SELECT predicted_high FROM pc)
        WHERE c IS NOT NULL),
cm AS (SELECT a.c AS actual, b.c AS predicted,
              (SELECT count(*) FROM pc WHERE actual_high = a.c AND predicted_high = b.c) AS count
       FROM cls a, cls b)"""


def _selection_queries() -> dict[str, str]:
    q = {}
    q["label_high_risk"] = f"WITH {PRODUCTION}, {RISK} SELECT order_id, actual_scrap_qty, high_scrap_risk FROM lab"
    # final risk frame: forbidden/actual/shift columns dropped; text columns
    # of this dataset hold no numbers and vanish; datetimes -> epoch ns
    keep_num = ["order_id"] + [f for f in _feature_names() if not f.endswith("_mode")]
    sel = ", ".join([f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in keep_num])
    fills = ", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in keep_num)
    q["coerce_numeric_frame"] = rounded(f"""WITH {ML}, thr AS (SELECT quantile_cont(actual_scrap_qty, 0.75) AS t FROM ml),
c AS (SELECT coalesce(CAST(ml.actual_scrap_qty > thr.t AS INTEGER), 0) AS target, {sel} FROM ml, thr)
SELECT target, {fills} FROM c""", keep_num)
    parts = []
    for c in ML_FEATURES:
        if c in ML_GAPS:
            parts.append(f'coalesce(CAST("{c}" AS DOUBLE), (SELECT quantile_cont("{c}", 0.5) FROM ml)) AS "{c}"')
        else:
            parts.append(f'"{c}"')
    q["fill_median"] = rounded(f"WITH {ML} SELECT {', '.join(parts)} FROM ml", ML_GAPS)
    q["group_split"] = f"""WITH {ML}, {_split_cte('ml', _gkey('machine_id', 'date_key'), 's')}
SELECT order_id, machine_id, date_key, split FROM s"""
    q["row_split"] = f"""WITH {PRODUCTION}, {_split_cte('production', _gkey('order_id'), 's')}
SELECT order_id, split FROM s"""
    q["stratified_folds"] = f"""WITH {PRODUCTION}, {RISK}
SELECT order_id, high_scrap_risk,
  CAST((row_number() OVER (PARTITION BY high_scrap_risk ORDER BY {_gkey('order_id')}) - 1) % 5 AS INTEGER) AS fold
FROM lab"""
    g = "concat_ws('_', coalesce(CAST(machine_id AS VARCHAR), 'nan'), coalesce(CAST(date_key AS VARCHAR), 'nan'))"
    q["split_report"] = f"""WITH {ML}, {_split_cte('ml', _gkey('machine_id', 'date_key'), 's')},
b AS (SELECT split AS side, {g} AS g, actual_scrap_qty AS y FROM s)
SELECT side, count(*) AS rows, {_r('count(*) / (SELECT count(*) FROM b)')} AS share, count(DISTINCT g) AS groups,
  {_r('count(*) / count(DISTINCT g)')} AS rows_per_group, {_r('avg(y)')} AS target_mean,
  {_r('stddev_pop(y)')} AS target_std,
  (SELECT count(*) FROM (SELECT g FROM b GROUP BY g HAVING count(DISTINCT side) > 1)) AS group_overlap
FROM b GROUP BY side"""
    nulls = " + ".join(f'count(*) FILTER (WHERE "{f}" IS NULL)' for f in ML_FEATURES)
    q["matrix_summary"] = f"""WITH {ML}
SELECT count(*) AS rows, {len(ML_FEATURES)} AS features,
  {_r(f'({nulls}) * 100.0 / (count(*) * {len(ML_FEATURES)})')} AS missing_pct,
  {_r('avg(actual_scrap_qty)')} AS target_mean, {_r('stddev_pop(actual_scrap_qty)')} AS target_std,
  {_r('CAST(min(actual_scrap_qty) AS DOUBLE)')} AS target_min, {_r('CAST(max(actual_scrap_qty) AS DOUBLE)')} AS target_max
FROM ml"""
    q["naive_baseline"] = f"""WITH {ML}, {_split_cte('ml', _gkey('machine_id', 'date_key'), 's')},
m AS (SELECT avg(actual_scrap_qty) AS m FROM s WHERE split = 'train')
SELECT {_r('m.m')} AS mean_prediction, {_r('avg(abs(actual_scrap_qty - m.m))')} AS mae,
  {_r('sqrt(avg((actual_scrap_qty - m.m) * (actual_scrap_qty - m.m)))')} AS rmse
FROM s, m WHERE split = 'test' GROUP BY m.m"""
    q["regression_metrics"] = f"""WITH {PERSIST},
e AS (SELECT scrap_quantity AS y, scrap_lag_1 - scrap_quantity AS e FROM ts
      WHERE scrap_quantity IS NOT NULL AND scrap_lag_1 IS NOT NULL)
SELECT count(*) AS n, {_r('avg(abs(e))')} AS mae, {_r('sqrt(avg(e * e))')} AS rmse,
  {_r('avg(abs(e)) / avg(y) * 100')} AS mae_pct_of_mean, {_r('avg(y)')} AS y_mean, {_r('stddev_pop(y)')} AS y_std,
  {_r('CAST(max(y) - min(y) AS DOUBLE)')} AS y_range
FROM e"""
    q["confusion_matrix"] = f"WITH {PERSIST} SELECT actual, predicted, count FROM cm"
    q["classification_metrics"] = f"""WITH {PERSIST},
per AS (SELECT actual AS cls, sum(count) AS support, sum(count) FILTER (WHERE actual = predicted) AS tp
        FROM cm GROUP BY actual),
pn AS (SELECT predicted AS cls, sum(count) AS pn FROM cm GROUP BY predicted),
m AS (SELECT CAST(per.cls AS VARCHAR) AS class,
             coalesce(CASE WHEN pn.pn <> 0 THEN tp / pn.pn END, 0) AS precision,
             coalesce(CASE WHEN support <> 0 THEN tp / support END, 0) AS recall,
             CAST(support AS BIGINT) AS support, tp
      FROM per JOIN pn USING (cls)),
m2 AS (SELECT *, coalesce(CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) END, 0)
                   AS f1 FROM m)
SELECT class, {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1')} AS f1, support FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, {_r('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', {_r('avg(precision)')}, {_r('avg(recall)')}, {_r('avg(f1)')}, CAST(sum(support) AS BIGINT)
  FROM m2
UNION ALL SELECT 'weighted avg', {_r('sum(precision * support) / sum(support)')},
  {_r('sum(recall * support) / sum(support)')}, {_r('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT)
  FROM m2"""
    return q


BROKEN = "SELECT 1 FROM events WHERE user_id % 20 = 3 AND event_id % 97 = 0"


def _source_queries() -> dict[str, str]:
    return {
        "file_roundtrip": _daily_features_sql(),
        "machine_filter": f"WITH {PRODUCTION} SELECT * FROM production WHERE replace(replace(machine_nr, '-', ''), ' ', '') = 'M105'",
        "isolated_features": _daily_features_sql().replace("FROM ev)", f"FROM ev WHERE user_id % 20 <> 11 AND NOT (user_id % 20 = 3 AND EXISTS ({BROKEN})))"),
        "quarantine": f"""WITH placed AS (SELECT *, row_number() OVER (PARTITION BY user_id % 20 ORDER BY event_id) + 1 AS line FROM events)
SELECT 3 AS grp, line, 'timestamp' AS "column", 'not a timestamp' AS reason, 'no time' AS text FROM placed
WHERE user_id % 20 = 3 AND event_id % 97 = 0
UNION ALL SELECT 11, 1, 'value', 'the header lacks it', 'machine_def,timestamp,variable_name,variable_attribute'
WHERE EXISTS (SELECT 1 FROM events WHERE user_id % 20 = 11)""",
        "file_manifest": """SELECT CASE user_id % 20 WHEN 11 THEN 'machine_def,timestamp,variable_name,variable_attribute'
  WHEN 5 THEN 'variable_attribute,value,variable_name,timestamp,machine_def'
  ELSE 'machine_def,timestamp,variable_name,value,variable_attribute' END AS header, count(DISTINCT user_id % 20) AS files
FROM events GROUP BY 1""",
    }


CUST_NAN = """cn AS (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL
              WHEN c_custkey % 97 = 0 THEN c_acctbal * 50 ELSE c_acctbal END AS balance
  FROM customer)"""


def _missing_queries() -> dict[str, str]:
    """NaN counts as missing (NULL here), dates of other layouts, and files by header name."""
    cols = [("c_custkey", False), ("c_mktsegment", False), ("balance", False)]
    missing, ranges = _missing_sql("cn", cols, "customer"), _range_sql("cn", "balance", 0.0, 9000.0, "customer")
    top = """(SELECT string_agg(v || ':' || CAST(n AS VARCHAR), '|' ORDER BY n DESC, v)
   FROM (SELECT c_mktsegment AS v, count(*) AS n FROM cn WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5))"""
    stats = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS std,
  {_r(f'CAST(min({c}) AS DOUBLE)')} AS min, {_r(f'CAST(max({c}) AS DOUBLE)')} AS max, CAST(NULL AS BIGINT) AS unique_count,
  CAST(NULL AS VARCHAR) AS top_values FROM cn""" for c, t in (("c_custkey", "bigint"), ("balance", "double")))
    stats += f""" UNION ALL SELECT 'c_mktsegment', 'string', NULL, NULL, NULL, NULL, (SELECT count(DISTINCT c_mktsegment) FROM cn), {top}"""
    day = "strftime(order_start, '%Y-%m-%d')"
    iso = f"CASE WHEN order_id % 5 = 0 THEN strftime(order_start, '%Y-%m-%d %H:%M:%S') ELSE {day} END"
    mixed = "CASE WHEN order_id % 2 = 0 THEN strftime(order_start, '%Y-%m-%d') ELSE strftime(order_start, '%d/%m/%Y') END"
    none = {k: "CAST(NULL AS DOUBLE)" for k in ("violation_count", "actual_min", "actual_max", "missing_count", "missing_pct", "duplicate_count")}

    def details(column: str, kind: str, source: str, **known: str) -> str:
        values = ", ".join(f"CAST({_r(v)} AS DOUBLE) AS {k}" if k in known else f"{v} AS {k}" for k, v in (none | known).items())
        return f"""SELECT {column} AS "column", '{kind}' AS issue_type, {values} FROM {source}"""

    parts = [
        details("'balance'", "out_of_range", "cn HAVING count(*) FILTER (WHERE balance < 0) > 0", violation_count="CAST(count(*) FILTER (WHERE balance < 0) AS DOUBLE)", actual_min="min(balance)"),
        details("'balance'", "out_of_range", "cn HAVING count(*) FILTER (WHERE balance > 9000) > 0", violation_count="CAST(count(*) FILTER (WHERE balance > 9000) AS DOUBLE)", actual_max="max(balance)"),
        *(details(f"'{c}'", "missing_values", f"cn HAVING count(*) FILTER (WHERE {c} IS NULL) > 0", missing_count=f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)", missing_pct=f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)") for c, _ in cols),
        *(details("CAST(NULL AS VARCHAR)", kind, f"(SELECT sum(c - 1) AS dup FROM (SELECT count(*) AS c FROM ofacts GROUP BY {by})) WHERE dup > 0", duplicate_count="CAST(dup AS DOUBLE)")
          for kind, by in (("duplicates", "ALL_COLS"), ("duplicate_keys", "o_custkey, o_orderdate"))),
    ]
    every = "o_custkey, o_orderdate, o_orderstatus, o_orderpriority"
    counter = "FILTER (WHERE variable_name IN ('Shot_counter', 'Scrap_counter') AND vn IS NOT NULL)"
    production_issues = _validate_production_body()
    reading_issues = _quality_queries()["validate_readings"].split("FROM ev) ", 1)[1]
    return {
        "nan_missing": f"WITH {CUST_NAN} {missing}",
        "nan_ranges": f"WITH {CUST_NAN} {ranges}",
        "nan_outliers": f"WITH {CUST_NAN} " + _outlier_sql("cn", "balance", 1.5, "customer"),
        "nan_high_risk": f"""WITH {CUST_NAN}, t AS (SELECT quantile_cont(balance, 0.75) AS t FROM cn)
SELECT c_custkey, CAST(coalesce(balance > t.t, false) AS INTEGER) AS high_scrap_risk FROM cn, t""",
        "nan_column_stats": f"WITH {CUST_NAN} {stats}",
        "nan_dataset_summary": f"""WITH {CUST_NAN}
SELECT 4 AS total_columns, 1 AS feature_columns, count(*) AS total_rows, count(balance) AS target_count,
  {_r('avg(balance)')} AS target_mean, {_r('stddev_samp(balance)')} AS target_std, {_r('min(balance)')} AS target_min,
  {_r('max(balance)')} AS target_max, count(*) FILTER (WHERE balance = 0) AS target_zeros,
  count(*) FILTER (WHERE balance > 0) AS target_non_zeros,
  {_r('count(*) FILTER (WHERE balance IS NULL) * 100.0 / count(*)')} AS feature_missing_pct,
  count(balance) AS rows_with_features, count(*) - count(balance) AS rows_without_features,
  count(DISTINCT c_mktsegment) AS unique_machines, count(DISTINCT c_mktsegment) AS unique_dates FROM cn""",
        "nan_daily_scrap": """SELECT CAST(l_shipdate AS DATE) AS date, 'M-' || CAST(l_suppkey AS VARCHAR) AS machine_id,
  l_returnflag AS tool_id, l_linestatus AS part_number,
  max(CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_quantity AS DOUBLE) END) AS scrap_quantity
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL""",
        "standardize_date_iso": f"WITH {PRODUCTION} SELECT order_id, {iso} AS date, CASE WHEN order_id % 5 <> 0 THEN {day} END AS date_key FROM production",
        "standardize_date_mixed": f"WITH {PRODUCTION} SELECT order_id, {mixed} AS date, strftime(order_start, '%Y-%m-%d') AS date_key FROM production",
        "read_by_name": f"""WITH {PRODUCTION}
SELECT order_id, CASE WHEN order_id % 2 = 0 THEN machine_id END AS machine_id,
  CASE WHEN order_id % 13 = 0 THEN NULL WHEN order_id % 997 = 0 THEN actual_scrap_qty + 0.5 ELSE CAST(actual_scrap_qty AS DOUBLE) END
    AS actual_scrap_qty FROM production""",
        "long_features": f"""WITH {PREP},
m AS (SELECT machine_def, agg_date, variable_name, value AS mode FROM (
  SELECT machine_def, agg_date, variable_name, value,
         row_number() OVER (PARTITION BY machine_def, agg_date, variable_name ORDER BY count(*) DESC, value) AS rn
  FROM prep WHERE variable_name = 'Machine_status' AND value IS NOT NULL
  GROUP BY machine_def, agg_date, variable_name, value) WHERE rn = 1)
SELECT machine_def, agg_date, variable_name, {_r('avg(vn)')} AS mean, {_r('max(vn)')} AS max, {_r('stddev_samp(vn)')} AS std,
  count(vn) AS count, {_r(f'arg_min(vn, row(tsp, vn)) {counter}')} AS "first", {_r(f'arg_max(vn, row(tsp, vn)) {counter}')} AS "last",
  {_r(f'arg_max(vn, row(tsp, vn)) {counter} - arg_min(vn, row(tsp, vn)) {counter}')} AS delta, CAST(NULL AS VARCHAR) AS mode
FROM prep WHERE vn IS NOT NULL AND variable_name IS NOT NULL GROUP BY machine_def, agg_date, variable_name
UNION ALL SELECT machine_def, agg_date, variable_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, mode FROM m""",
        "build_ml_dataset": _join_sql("LEFT"),
        "rows_per_date": f"WITH {PRODUCTION} SELECT date, count(*) AS rows FROM production GROUP BY date",
        "check_columns": f"""SELECT 'HydraData' AS dataset, 'cavity' AS "column", 'missing_column' AS issue_type, 'error' AS severity,
  'column cavity is required but absent' AS message, CAST(NULL AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS pct
UNION ALL SELECT 'HydraData', 'remark', 'missing_column', 'info', 'column remark is absent (optional)', NULL, NULL""",
        "check_types": """SELECT 'HydraData' AS dataset, 'date' AS "column", 'type_mismatch' AS issue_type, 'warning' AS severity,
  'date should be datetime but is string' AS message, CAST(NULL AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS pct
UNION ALL SELECT 'HydraData', 'shift', 'type_mismatch', 'warning', 'shift should be categorical but is int', NULL, NULL""",
        "validate_dispatch": f"WITH {PRODUCTION}, {READINGS} SELECT * FROM ({production_issues}) UNION ALL SELECT * FROM ({reading_issues})",
        "variable_summary": f"""WITH {READINGS},
c AS (SELECT variable_name AS variable, count(*) AS readings FROM readings WHERE variable_name IS NOT NULL GROUP BY 1)
SELECT (SELECT count(*) FROM c) AS unique_variables, variable, readings FROM c ORDER BY readings DESC, variable LIMIT 10""",
        "issue_details": f"WITH {CUST_NAN}, {ORDER_FACTS} " + " UNION ALL ".join(parts).replace("ALL_COLS", every),
    }


def _stream_queries() -> dict[str, str]:
    # append mode emits a day once the watermark (latest event - 1 day) has
    # reached the end of that day
    base = _daily_features_sql()
    return {"stream_daily_features": f"""SELECT * FROM ({base}) AS f
WHERE CAST(agg_date AS DATE) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events)"""}


def _extra_queries() -> dict[str, str]:
    ctx = _scoring_context_sql()
    return {
        "risk_status": f"""SELECT {KEYS}, rolling_avg_3 AS prediction,
  CASE WHEN rolling_avg_3 > 40.0 THEN 'HIGH RISK' ELSE 'NORMAL' END AS status FROM ({ctx}) AS c""",
        "standardize_columns": f"WITH {PRODUCTION} SELECT * FROM production",
        "check_outliers_sensor": _outlier_sql("events", "value", 1.5, "events"),
        "variable_counts": f"""WITH {READINGS},
c AS (SELECT variable_name AS value, count(*) AS count FROM readings WHERE variable_name IS NOT NULL GROUP BY 1)
SELECT value, count, round(count * 100.0 / (SELECT count(*) FROM readings), {DIGITS}) AS pct,
  row_number() OVER (ORDER BY count DESC, value) AS rank FROM c""",
    }


def _model_queries() -> dict[str, str]:
    """What surrounds trained models; their own figures are checks that must all be true."""
    q = {}
    target = f"""{_r('avg(y)')} AS y_mean, {_r('stddev_pop(y)')} AS y_std, {_r('CAST(max(y) - min(y) AS DOUBLE)')} AS y_range"""
    q["rf_regressor"] = f"""WITH {ML}, {_split_cte('ml', _gkey('machine_id', 'date_key'), 's')},
m AS (SELECT avg(actual_scrap_qty) AS m FROM s WHERE split = 'train'),
t AS (SELECT actual_scrap_qty AS y, m.m FROM s, m WHERE split = 'test')
SELECT count(*) AS n, {target}, {_r('any_value(m)')} AS mean_prediction, {_r('avg(abs(y - m))')} AS baseline_mae,
  {_r('sqrt(avg((y - m) * (y - m)))')} AS baseline_rmse, true AS fits, true AS in_range FROM t"""
    q["feature_importance"] = f"""WITH {ML} SELECT f AS feature, true AS in_order, true AS adds_up, {min(15, len(ML_FEATURES))} AS top
FROM (SELECT unnest({ML_FEATURES}) AS f) WHERE EXISTS (SELECT 1 FROM ml)"""

    def supports(extra: str = "") -> str:
        return f"""c AS (SELECT y, count(*) AS n FROM t GROUP BY y)
SELECT CAST(y AS VARCHAR) AS class, n AS support, true AS shares, true AS fits{extra} FROM c
UNION ALL SELECT k, CAST((SELECT sum(n) FROM c) AS BIGINT), true, true{extra.split(' AS')[0]} FROM (SELECT unnest(['accuracy', 'macro avg', 'weighted avg']) AS k)"""

    risk = f"""{ML}, thr AS (SELECT quantile_cont(actual_scrap_qty, 0.75) AS t FROM ml),
lab AS (SELECT ml.*, coalesce(CAST(ml.actual_scrap_qty > thr.t AS INTEGER), 0) AS y FROM ml, thr)"""
    q["risk_classifier"] = f"""WITH {risk}, {_split_cte('lab', _gkey('date'), 's')}, t AS (SELECT y FROM s WHERE split = 'test'), {supports()}"""
    row = "md5(CAST(order_id AS VARCHAR) || '.0' || '#42')"  # the key is a double by then
    q["final_risk_model"] = f"""WITH {risk}, {_split_cte('lab', row, 's')}, t AS (SELECT y FROM s WHERE split = 'test'), {supports(', true AS reloaded_equal')}"""
    q["cross_validate"] = f"""WITH {risk}, c AS (SELECT y, count(*) AS n FROM lab GROUP BY y)
SELECT CAST(i + 1 AS VARCHAR) AS fold, CAST(sum((n - i + 4) // 5) AS BIGINT) AS rows,
  CAST(coalesce(sum((n - i + 4) // 5) FILTER (WHERE y = 1), 0) AS BIGINT) AS positives, true AS fine, false AS verdict_given
FROM c, range(5) r(i) GROUP BY i
UNION ALL SELECT 'mean', CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE y = 1), 0) AS BIGINT), true, true FROM c"""
    q["compare_models"] = """SELECT m AS model, true AS fine, true AS one_best
FROM (SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting']) AS m) WHERE EXISTS (SELECT 1 FROM orders)"""
    q["forecaster"] = f"""WITH {PERSIST}, t AS (SELECT scrap_quantity AS y FROM ts WHERE scrap_quantity IS NOT NULL)
SELECT count(*) AS n, {target}, true AS fits FROM t"""
    q["forecast_next_day"] = f"""SELECT {KEYS}, last_date, forecast_date, scrap_lag_1 AS yesterday, true AS delta_fits, true AS status_fits
FROM ({_scoring_context_sql()}) AS c"""
    q["sensor_model"] = f"""WITH tr AS ({_sensor_training_sql()}), {_split_cte('tr', _gkey('date', 'machine_id'), 's')},
t AS (SELECT scrap_quantity AS y FROM s WHERE split = 'test')
SELECT count(*) AS n, {target}, true AS error_in_range FROM t"""
    q["stream_score"] = f"SELECT *, true AS half_fits, true AS status_fits FROM ({_sensor_training_sql()}) AS t"
    q["stream_alerts"] = "SELECT true AS agree, true AS all_above WHERE EXISTS (SELECT 1 FROM orders)"
    q["validation_json"] = f"""WITH {PRODUCTION}, issues AS ({_validate_production_body()})
SELECT 'HydraData' AS dataset, (SELECT count(*) FROM production) AS row_count, count(*) AS issue_count,
  count(*) FILTER (WHERE severity IN ('critical', 'error')) = 0 AS is_valid, string_agg(message, '; ' ORDER BY message) AS messages, 9 AS columns
FROM issues"""
    return q


def _stored_queries() -> dict[str, str]:
    cols = "o_custkey, o_orderdate, o_orderstatus, o_orderpriority"
    nan = [("c_custkey", False), ("c_mktsegment", False), ("balance", False)]
    risk_names = [f for f in ["order_id", "shift"] + [n for n in _feature_names() if not n.endswith("_mode")]
                  if not any(w in f.lower() for w in ("scrap", "risk", "qty", "duration", "runtime", "counter", "production"))]

    def values(rule: str, names: list[str], source: str) -> str:
        return " UNION ALL ".join(f"""SELECT '{rule}' AS rule, '{f}' AS feature, count("{f}") AS "values" FROM {source}""" for f in names)

    return {
        "repeated_rows": f"SELECT {cols}, count(*) AS count FROM orders GROUP BY {cols} HAVING count(*) > 1",
        "top_order_keys": f"""WITH c AS (SELECT l_orderkey AS value, count(*) AS count FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1)
SELECT value, count, round(count * 100.0 / (SELECT count(*) FROM lineitem), {DIGITS}) AS pct,
  row_number() OVER (ORDER BY count DESC, value) AS rank FROM c ORDER BY count DESC, value LIMIT 10""",
        "column_stats_sketched": _summary_queries()["column_stats"],
        "distinct_by_machine": f"""WITH {READINGS} SELECT machine_def, count(*) AS rows, count(DISTINCT variable_name) AS variable_name_distinct,
  count(DISTINCT CAST("timestamp" AS DATE)) AS day_distinct FROM readings GROUP BY machine_def""",
        "bucketed_join": _join_sql("LEFT"),
        "partition_overwrite": f"""SELECT * FROM ({_daily_features_sql()}) AS f
WHERE agg_date NOT IN ('2024-01-05', '2024-01-06') OR machine_def < 'M00050'""",
        "validate_on_write": f"WITH {CUST_NAN} {_min_rows_sql('cn', 'customer')} UNION ALL {_missing_sql('cn', nan, 'customer')} UNION ALL {_range_sql('cn', 'balance', 0.0, 9000.0, 'customer')}",
        "stream_history": f"""WITH {READINGS} SELECT machine_def, "timestamp", variable_name,
  CASE WHEN count(value) = count(*) THEN min(value) END AS value FROM readings
WHERE machine_def IS NOT NULL AND "timestamp" IS NOT NULL AND variable_name IS NOT NULL GROUP BY ALL""",
        "sample_file": f"WITH {PRODUCTION} SELECT order_id, machine_id, shift FROM production ORDER BY order_id LIMIT 100",
        "input_gates": "SELECT 'target and machine' AS gate, count(*) AS rows FROM orders UNION ALL SELECT 'cavity', 0",
        "feature_rules": f"""WITH {ML}, tr AS ({_sensor_training_sql()}) {values('baseline', ML_FEATURES, 'ml')}
UNION ALL {values('risk', risk_names, 'ml')} UNION ALL {values('sensor', VERT_VARS, 'tr')}""",
    }
