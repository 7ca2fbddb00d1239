"""The catalog's queries in ANSI SQL, for checking their results."""

from __future__ import annotations

from almenara.fixed_values import TEXT_REPAIR, WEEKDAYS_EN, WEEKDAYS_ES
from almenara.functions.text import WHITE_SPACE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chars(value: str) -> str:
    """SQL text from code points, for characters that do not show."""
    return " || ".join(f"chr({ord(c)})" for c in value)


# Sunday is day 0 there
_DAYS_ES = "[" + ", ".join(_text(d) for d in WEEKDAYS_ES[-1:] + WEEKDAYS_ES[:-1]) + "]"
_DAYS_EN = "[" + ", ".join(_text(d) for d in WEEKDAYS_EN[-1:] + WEEKDAYS_EN[:-1]) + "]"


def _day_es(column: str) -> str:
    return f"list_extract({_DAYS_ES}, CAST(dayofweek({column}) AS INTEGER) + 1)"


def _repaired(expression: str) -> str:
    """Sequences become private-use characters, then all single ones change at once."""
    sequences = [k for k in TEXT_REPAIR if len(k) > 1]
    singles = [k for k in TEXT_REPAIR if len(k) == 1]
    for i, key in enumerate(sequences):
        expression = f"replace({expression}, {_chars(key)}, chr({0xE000 + i}))"
    source = " || ".join([_chars("".join(singles))] + [f"chr({0xE000 + i})" for i in range(len(sequences))])
    target = _chars("".join(TEXT_REPAIR[k] for k in singles + sequences))
    return f"translate({expression}, {source}, {target})"


_EVENT_TIMES = """
events_in AS (
  SELECT event_id, CAST(ts AS DATE) AS "FECHA", CAST(hour(ts) AS INTEGER) AS "HORA",
         event_type AS "TIPO_INCIDENTE", ts
  FROM events
)"""

_LOCATED = """
located AS (
  SELECT o.*, n.n_name, c.c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_INCIDENTS = (
    _LOCATED
    + """,
inc AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE",
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts,
         CAST(c_nationkey AS BIGINT) AS "CODIGO_LOCALIDAD",
         nullif(n_name, 'NATION_7') AS "LOCALIDAD",
         o_orderstatus AS "TIPO_INCIDENTE",
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS "PRIORIDAD_FINAL",
         CAST(o_orderdate AS DATE) AS "FECHA"
  FROM located
),
dim AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS code, n_nationkey * 1.5e0 - 74.25e0 AS "X",
         n_nationkey * 0.25e0 + 4.5e0 AS "Y"
  FROM nation
)"""
)

_REQUESTED = (
    _INCIDENTS
    + f""",
kept AS (
  SELECT *, CAST(hour(ts) AS INTEGER) AS "HORA", {_day_es('"FECHA"')} AS "DIA_SEMANA"
  FROM inc
  WHERE "FECHA" BETWEEN DATE '1996-02-01' AND DATE '2000-11-30' AND "TIPO_INCIDENTE" IN ('F', 'O')
)"""
)

_TEXT_CODES = (
    _INCIDENTS
    + """,
coded AS (
  SELECT "NUMERO_INCIDENTE", "LOCALIDAD",
         CASE WHEN "CODIGO_LOCALIDAD" = 5 THEN NULL ELSE CAST("CODIGO_LOCALIDAD" AS VARCHAR) END AS code
  FROM inc
),
points AS (
  SELECT k.code AS "CODIGO_LOCALIDAD", k.n AS "TOTAL", k.label AS "LOCALIDAD", d."X", d."Y"
  FROM (SELECT code, count(*) AS n, min("LOCALIDAD") AS label FROM coded WHERE code IS NOT NULL GROUP BY code) k
  LEFT JOIN dim d ON k.code = CAST(d.code AS VARCHAR)
)"""
)


def _matrix(cells: str) -> str:
    columns = ",\n".join(
        f"""CAST(coalesce(sum("TOTAL") FILTER (WHERE "HORA" = {h}), 0) AS BIGINT) AS "H{h:02d}\""""
        for h in range(24)
    )
    return f'SELECT "DIA_SEMANA", {columns} FROM ({cells}) GROUP BY "DIA_SEMANA"'


_EVENT_CELLS = f"""
SELECT {_day_es('"FECHA"')} AS "DIA_SEMANA", "HORA", count(*) AS "TOTAL" FROM events_in GROUP BY 1, 2"""

_KEPT_CELLS = """
SELECT "DIA_SEMANA", "HORA", count(*) AS "TOTAL" FROM kept
WHERE "DIA_SEMANA" IS NOT NULL AND "HORA" IS NOT NULL GROUP BY 1, 2"""

_ORDER_TYPES = """
order_types AS (
  SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS "PRIORIDAD_FINAL", o_orderstatus AS "TIPO_INCIDENTE"
  FROM orders
)"""


def _rollup(source: str) -> str:
    return f"""
SELECT "PRIORIDAD_FINAL", "TIPO_INCIDENTE",
       CAST(grouping("PRIORIDAD_FINAL", "TIPO_INCIDENTE") AS INTEGER) AS "NIVEL", count(*) AS "TOTAL"
FROM {source} WHERE "PRIORIDAD_FINAL" IS NOT NULL AND "TIPO_INCIDENTE" IS NOT NULL
GROUP BY ROLLUP ("PRIORIDAD_FINAL", "TIPO_INCIDENTE")"""


def _join_then_group(facts: str, kind: str, group: str = "i.code") -> str:
    """The join spelled out: dimension first, then totals per incident code."""
    return f"""
SELECT {group} AS "CODIGO_LOCALIDAD", count(i.number) AS "TOTAL", round(avg(d."X"), 6) AS "X",
       round(avg(d."Y"), 6) AS "Y", min(i.label) AS "LOCALIDAD"
FROM dim d {kind} JOIN {facts} i ON d.code = i.code GROUP BY 1"""


_MAP_FACTS = """(SELECT "CODIGO_LOCALIDAD" AS code, "NUMERO_INCIDENTE" AS number, "LOCALIDAD" AS label FROM inc)"""
_SUPPLIER_FACTS = """(SELECT CAST(nullif(s_nationkey, 4) AS BIGINT) AS code, s_name AS number, right(s_name, 1) AS label
 FROM supplier)"""

_REPORT_MAP = """
SELECT k.code AS "CODIGO_LOCALIDAD", k.n AS "TOTAL", k.label AS "LOCALIDAD", d."X", d."Y"
FROM (SELECT "CODIGO_LOCALIDAD" AS code, count(*) AS n, min("LOCALIDAD") AS label
      FROM kept WHERE "CODIGO_LOCALIDAD" IS NOT NULL GROUP BY 1) k
LEFT JOIN dim d ON k.code = d.code"""

_REPORT_TREND = 'SELECT "FECHA", count(*) AS "TOTAL" FROM kept GROUP BY 1'
_REPORT_LEAVES = """
SELECT "PRIORIDAD_FINAL", "TIPO_INCIDENTE", count(*) AS "TOTAL" FROM kept
WHERE "PRIORIDAD_FINAL" IS NOT NULL AND "TIPO_INCIDENTE" IS NOT NULL GROUP BY 1, 2"""


def _top(source: str, key: str) -> str:
    return f'SELECT "{key}", count(*) AS "TOTAL" FROM {source} GROUP BY 1 ORDER BY 2 DESC, 1 ASC NULLS FIRST LIMIT 10'


_RAW_DATES = (
    _LOCATED
    + """,
timed AS (
  SELECT *, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS t,
         CASE WHEN o_orderstatus = 'O' THEN 'month first'
              WHEN o_orderstatus = 'P' AND day(o_orderdate) > 12 THEN 'day first'
              WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE 'iso' END AS written
  FROM located
)"""
)

_INGEST_TIME = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"

ORACLE: dict[str, str] = {
    "daily_totals": f'WITH {_EVENT_TIMES} SELECT "FECHA", count(*) AS "TOTAL" FROM events_in GROUP BY 1',
    "weekday_hour_totals": f"WITH {_EVENT_TIMES} {_EVENT_CELLS}",
    "weekday_hour_matrix": f"WITH {_EVENT_TIMES} {_matrix(_EVENT_CELLS)}",
    "locality_totals": f'WITH {_LOCATED} SELECT n_name AS "LOCALIDAD", count(*) AS "TOTAL" FROM located GROUP BY 1',
    "type_totals": 'SELECT event_type AS "TIPO_INCIDENTE", count(*) AS "TOTAL" FROM events GROUP BY 1',
    "priority_type_totals": f"""WITH {_ORDER_TYPES}
SELECT "PRIORIDAD_FINAL", "TIPO_INCIDENTE", count(*) AS "TOTAL" FROM order_types GROUP BY 1, 2""",
    "priority_type_totals_not_null": f"""WITH {_ORDER_TYPES}
SELECT "PRIORIDAD_FINAL", "TIPO_INCIDENTE", count(*) AS "TOTAL" FROM order_types
WHERE "PRIORIDAD_FINAL" IS NOT NULL AND "TIPO_INCIDENTE" IS NOT NULL GROUP BY 1, 2""",
    "priority_type_rollup": f"WITH {_ORDER_TYPES} {_rollup('order_types')}",
    "top_localities": f'WITH {_LOCATED}, named AS (SELECT n_name AS "LOCALIDAD" FROM located) {_top("named", "LOCALIDAD")}',
    "top_types": f'WITH typed AS (SELECT p_type AS "TIPO_INCIDENTE" FROM part) {_top("typed", "TIPO_INCIDENTE")}',
    "date_bounds": f'WITH {_EVENT_TIMES} SELECT min("FECHA") AS "FECHA_MIN", max("FECHA") AS "FECHA_MAX" FROM events_in',
    "domain_values": """SELECT DISTINCT event_type AS "TIPO_INCIDENTE" FROM events
WHERE event_type IS NOT NULL ORDER BY 1""",
    "filtered_daily": """
SELECT CAST(o_orderdate AS DATE) AS "FECHA", count(*) AS "TOTAL" FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
  AND o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'P') GROUP BY 1""",
    "open_range_daily": """
SELECT CAST(o_orderdate AS DATE) AS "FECHA", count(*) AS "TOTAL" FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2000-06-01' GROUP BY 1""",
    "empty_filter": """
SELECT count(*) = 0 AS "VACIO", 'none' AS "PEDIDO" FROM orders
WHERE o_orderdate >= DATE '1890-01-01' AND o_orderdate < DATE '1891-01-01'
UNION ALL
SELECT count(*) = 0, 'some' FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'""",
    "map_points": f"WITH {_TEXT_CODES} SELECT * FROM points",
    "map_points_dim_first": f"WITH {_INCIDENTS} {_join_then_group(_MAP_FACTS, 'LEFT')}",
    "map_points_keep_dimension": f"WITH {_INCIDENTS} {_join_then_group(_MAP_FACTS, 'LEFT', 'd.code')}",
    "map_join_kinds": f"WITH {_INCIDENTS} "
    + " UNION ALL ".join(
        f"SELECT *, '{k}' AS \"TIPO_JOIN\" FROM ({_join_then_group(_SUPPLIER_FACTS, k.upper())})"
        for k in ("inner", "left", "right", "full")
    ),
    "map_has_xy": f"""WITH {_TEXT_CODES} SELECT count("X") > 0 AND count("Y") > 0 AS "TIENE_XY" FROM points""",
    "small_side_join": """
SELECT s_nationkey, count(*) AS "TOTAL", sum(l_quantity) AS cantidad
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
    "geo_features": """
SELECT c_custkey AS "Codigo_Localidad",
       c_acctbal / 4 + CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS "X",
       c_nationkey * 0.5e0 + CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS "Y"
FROM customer""",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "report_trend": f"WITH {_REQUESTED} {_REPORT_TREND}",
    "report_heatmap": f"WITH {_REQUESTED} {_KEPT_CELLS}",
    "report_heatmap_matrix": f"WITH {_REQUESTED} {_matrix(_KEPT_CELLS)}",
    "report_top_localities": f"WITH {_REQUESTED} {_top('kept', 'LOCALIDAD')}",
    "report_top_types": f"WITH {_REQUESTED} {_top('kept', 'TIPO_INCIDENTE')}",
    "report_hierarchy": f"WITH {_REQUESTED} {_REPORT_LEAVES}",
    "report_hierarchy_totals": f"WITH {_REQUESTED} {_rollup('kept')}",
    "report_map": f"WITH {_REQUESTED} {_REPORT_MAP}",
    "cube_trend": f"WITH {_REQUESTED} {_REPORT_TREND}",
    "cube_hierarchy": f"WITH {_REQUESTED} {_REPORT_LEAVES}",
    "cube_map": f"WITH {_REQUESTED} {_REPORT_MAP}",
    "text_repair": "SELECT doc_id, "
    + _repaired("replace(replace(text, 'é', 'Ã©'), 'ü', 'Â¡')")
    + ' AS "TEXTO" FROM documents',
    "text_standard": f"""
SELECT doc_id, upper(replace(trim(replace(text, chr(160), ' '), {_chars(WHITE_SPACE)}), 'ß', 'SS')) AS "TEXTO"
FROM documents""",
    "label_map": """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'HERIDO' WHEN '2-HIGH' THEN NULL
            WHEN '3-MEDIUM' THEN 'FONTIBON'
            ELSE CASE o_orderstatus WHEN 'F' THEN 'FEMENINO' ELSE o_orderstatus END END AS "ETIQUETA"
FROM orders""",
    "priority_map": """
SELECT o_orderkey,
       CASE left(o_orderpriority, 1) WHEN '1' THEN 'CRITICA' WHEN '2' THEN 'ALTA' WHEN '3' THEN 'MEDIA'
            WHEN '4' THEN 'BAJA' ELSE left(o_orderpriority, 1) END AS "PRIORIDAD_FINAL"
FROM orders""",
    "code_standard": """
SELECT c_custkey,
       CAST(CASE WHEN c_nationkey = 0 THEN 1 WHEN c_nationkey = 1 THEN 10 WHEN c_nationkey IN (2, 3) THEN NULL
                 WHEN c_nationkey < 20 THEN c_nationkey END AS BIGINT) AS "CODIGO"
FROM customer""",
    "normalized_codes": f'WITH {_TEXT_CODES} SELECT "NUMERO_INCIDENTE", code AS "CODIGO" FROM coded',
    "null_tokens": """
SELECT doc_id, CASE lang WHEN 'es' THEN NULL WHEN 'fr' THEN 'Nan' ELSE lang END AS "VALOR",
       CASE WHEN lang IN ('es', 'fr') THEN NULL ELSE lang END AS "PALABRA"
FROM documents""",
    "blank_to_null": """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS "VALOR" FROM events""",
    "lenient_int": """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS "ENTERO"
FROM events""",
    "safe_timestamp": """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE date_trunc('second', ts) END AS "TS_SAFE"
FROM events""",
    "text_timestamp": f"""WITH {_RAW_DATES}
SELECT ' n' || CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE",
       CASE WHEN written = 'none' THEN NULL ELSE t END AS "TS"
FROM timed""",
    "date_parts": f"""WITH {_EVENT_TIMES}
SELECT "FECHA", "HORA", CAST(dayofweek("FECHA") + 1 AS INTEGER) AS "DOW", {_day_es('"FECHA"')} AS "DIA_SEMANA",
       list_extract({_DAYS_EN}, CAST(dayofweek("FECHA") AS INTEGER) + 1) AS "DIA_SEMANA_EN", count(*) AS "TOTAL"
FROM events_in GROUP BY ALL""",
    "synonym_coalesce": """
SELECT CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE",
       CASE WHEN o_orderstatus = 'P' THEN '7' END AS "CODIGO_LOCALIDAD",
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS "PRIORIDAD_FINAL"
FROM orders""",
    "hetero_union": """
SELECT o_orderkey, o_orderpriority, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, NULL, NULL FROM orders""",
    "clean_incidents": f"""WITH {_RAW_DATES},
typed AS (SELECT *, CASE WHEN written = 'none' THEN NULL ELSE t END AS ts FROM timed)
SELECT 'N' || CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE",
       ts AS "FECHA_INICIO_DESPLAZAMIENTO_MOVIL",
       CAST(CASE c_nationkey WHEN 3 THEN 17 WHEN 4 THEN NULL ELSE c_nationkey END AS BIGINT) AS "CODIGO_LOCALIDAD",
       CASE c_nationkey WHEN 10 THEN 'ENGATIVA' WHEN 9 THEN 'FONTIBON' WHEN 8 THEN NULL ELSE n_name END AS "LOCALIDAD",
       CAST(CASE o_orderstatus WHEN 'F' THEN 25 WHEN 'P' THEN 7 END AS INTEGER) AS "EDAD",
       'AÑOS' AS "UNIDAD",
       CASE o_orderstatus WHEN 'F' THEN 'FEMENINO' ELSE 'MASCULINO' END AS "GENERO",
       CASE o_orderstatus WHEN 'F' THEN 'HERIDO' ELSE 'TIPO ' || o_orderstatus END AS "TIPO_INCIDENTE",
       CASE left(o_orderpriority, 1) WHEN '1' THEN 'CRITICA' WHEN '2' THEN 'ALTA' WHEN '3' THEN 'MEDIA'
            WHEN '4' THEN 'BAJA' ELSE '5' END AS "PRIORIDAD_FINAL",
       '¿QUÉI N' AS "RECEPCION",
       CAST(ts AS DATE) AS "FECHA", CAST(hour(ts) AS INTEGER) AS "HORA",
       list_extract({_DAYS_EN}, CAST(dayofweek(ts) AS INTEGER) + 1) AS "DIA_SEMANA_EN",
       {_day_es("ts")} AS "DIA_SEMANA"
FROM typed""",
    "rejects": f"""WITH {_RAW_DATES}, named AS (
  SELECT *, ' n' || CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE" FROM timed)
SELECT "NUMERO_INCIDENTE", 'CODIGO_LOCALIDAD' AS "MOTIVO" FROM named WHERE c_nationkey = 4
UNION ALL SELECT "NUMERO_INCIDENTE", 'EDAD' FROM named WHERE o_orderstatus = 'O'
UNION ALL SELECT "NUMERO_INCIDENTE", 'FECHA_INICIO_DESPLAZAMIENTO_MOVIL' FROM named WHERE written = 'none'""",
    "csv_ingest": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE",
       {_INGEST_TIME} AS "FECHA_INICIO_DESPLAZAMIENTO_MOVIL",
       CAST(NULL AS VARCHAR) AS "CODIGO_LOCALIDAD",
       'USAQUÉN; "' || o_orderpriority || '"' AS "LOCALIDAD",
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS "EDAD",
       CASE WHEN o_orderstatus <> 'F' THEN 'línea 1' || chr(10) || o_orderstatus END AS "TIPO_INCIDENTE",
       o_orderpriority AS "PRIORIDAD_FINAL"
FROM orders""",
    "parquet_roundtrip": f'WITH {_EVENT_TIMES} SELECT "FECHA", count(*) AS "TOTAL" FROM events_in GROUP BY 1',
    "partition_roundtrip": f"""WITH {_EVENT_TIMES}
SELECT "FECHA", "TIPO_INCIDENTE", count(*) AS "TOTAL" FROM events_in
WHERE "FECHA" BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1, 2""",
    "stored_totals": f"""WITH {_INCIDENTS}, keyed AS (
  SELECT *, CAST(hour(ts) AS VARCHAR) AS hora, {_day_es('"FECHA"')} AS dia FROM inc)
SELECT 'diario' AS "TABLA", CAST("FECHA" AS VARCHAR) AS "CLAVE_1", CAST(NULL AS VARCHAR) AS "CLAVE_2",
       count(*) AS "TOTAL" FROM keyed GROUP BY 1, 2, 3
UNION ALL SELECT 'heatmap', dia, hora, count(*) FROM keyed GROUP BY 1, 2, 3
UNION ALL SELECT 'localidad', "LOCALIDAD", NULL, count(*) FROM keyed GROUP BY 1, 2, 3
UNION ALL SELECT 'tipo_incidente', "TIPO_INCIDENTE", NULL, count(*) FROM keyed GROUP BY 1, 2, 3
UNION ALL SELECT 'sunburst', "PRIORIDAD_FINAL", "TIPO_INCIDENTE", count(*) FROM keyed GROUP BY 1, 2, 3""",
    "spread_by_date": 'SELECT CAST(o_orderdate AS DATE) AS "FECHA", count(*) AS "TOTAL" FROM orders GROUP BY 1',
}

ORACLE["geo_files"] = ORACLE["geo_features"]
ORACLE["stored_totals_append"] = ORACLE["stored_totals"]
ORACLE["malformed_records"] = """
SELECT o_orderpriority || ';' || CAST(o_orderkey AS VARCHAR) || ';x' AS "REGISTRO" FROM orders WHERE o_orderkey % 7 = 0"""
ORACLE["text_timestamp_formats"] = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('milliseconds', ts) ELSE date_trunc('day', ts) END AS "TS"
FROM events"""
ORACLE["csv_date_orders"] = 'SELECT CAST(o_orderkey AS VARCHAR) AS "NUMERO_INCIDENTE", date_trunc(\'minute\', CAST(o_orderdate AS TIMESTAMP)) AS "TS" FROM orders'
ORACLE["merged_appends"] = ORACLE["stored_totals"]
ORACLE["retyped_texts"] = f'WITH {_EVENT_TIMES} SELECT "FECHA", "HORA", count(*) AS "TOTAL" FROM events_in GROUP BY 1, 2'
ORACLE["session_requests"] = f'SELECT *, (SELECT count(*) FROM orders) AS "INCIDENTES" FROM ({ORACLE["report_trend"]})'
ORACLE["clustered_month"] = ORACLE["partition_roundtrip"]
ORACLE["bloom_lookup"] = f"""WITH {_INCIDENTS} SELECT "NUMERO_INCIDENTE", "FECHA", "TIPO_INCIDENTE" FROM inc
WHERE "NUMERO_INCIDENTE" IN ('7', '33', 'absent')"""
ORACLE["footer_bounds"] = f"""WITH {_EVENT_TIMES}
SELECT min("FECHA") AS "FECHA_MIN", max("FECHA") AS "FECHA_MAX", count(*) AS "FILAS" FROM events_in"""
ORACLE["published_totals"] = ORACLE["stored_totals"]
ORACLE["top_types_many"] = ORACLE["top_types"]
ORACLE["top_orders_many"] = """
SELECT o_custkey AS "CLIENTE", count(*) AS "TOTAL" FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 ASC NULLS FIRST LIMIT 25"""
