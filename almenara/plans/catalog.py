"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.functions import codes, dates, text
from almenara.operators import aggregates as A
from almenara.operators.clean import concat_tables, drop_unnamed, project_expected, unify_synonyms
from almenara.operators.filters import ReportFilter, in_date_range, is_empty
from almenara.operators.joins import join_small, map_has_points, map_points, map_totals
from almenara.operators.sinks import spread, write_clustered, write_parquet, write_partitioned
from almenara.operators.standardize import rejects, standardize
from almenara.plans.publish import current_paths, publish_tables
from almenara.plans.report import ReportSession, incident_cube, prepare_incidents, report
from almenara.plans.stand_ins import (
    event_times,
    incidents,
    localities,
    raw_incidents,
    table,
    text_code_incidents,
)
from almenara.plans.tables import merge_appended, retype, write_tables
from almenara.schema import AGGREGATE_TABLES, DAY_FIRST_COLUMN
from almenara.session import scratch_folder
from almenara.sources.csv_folder import read_csv_folder
from almenara.sources.geojson import locality_points, parse_geojson, read_geojson
from almenara.sources.tables import read_parquet, read_totals, stored_bounds

Query = Callable[[SparkSession, str], DataFrame]

#: the request behind the report queries
REQUEST = ReportFilter("1996-02-01", "2000-11-30", "TODAS", ["F", "O"])


def wall_clock(column: str):
    """Timestamp without time zone, the same on every session time zone."""
    return F.col(column).cast("timestamp_ntz").alias(column)


# --- totals ----------------------------------------------------------------


def daily_totals(spark, sf_dir):
    return A.daily_trend(event_times(spark, sf_dir))


def weekday_hour_totals(spark, sf_dir):
    events = event_times(spark, sf_dir).withColumn("DIA_SEMANA", dates.weekday_es("FECHA"))
    return A.weekday_hour_totals(events)


def weekday_hour_matrix(spark, sf_dir):
    return A.weekday_hour_matrix(weekday_hour_totals(spark, sf_dir))


def _orders_per_locality(spark, sf_dir):
    """Order counts per locality. Counting per customer first shrinks the join
    and leaves no customer with more than one row."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("LOCALIDAD"))
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return counts.join(homes, F.col("o_custkey") == F.col("c_custkey"))


def locality_totals(spark, sf_dir):
    return A.locality_totals(_orders_per_locality(spark, sf_dir), weight="n")


def type_totals(spark, sf_dir):
    return A.type_totals(event_times(spark, sf_dir))


def _order_types(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("PRIORIDAD_FINAL"),
        F.col("o_orderstatus").alias("TIPO_INCIDENTE"),
    )


def priority_type_totals(spark, sf_dir):
    return A.priority_type_totals(_order_types(spark, sf_dir))


def priority_type_totals_not_null(spark, sf_dir):
    return A.priority_type_totals(_order_types(spark, sf_dir), keep_nulls=False)


def priority_type_rollup(spark, sf_dir):
    return A.hierarchy_totals(priority_type_totals_not_null(spark, sf_dir))


def top_localities(spark, sf_dir):
    return A.top_totals(_orders_per_locality(spark, sf_dir), "LOCALIDAD", weight="n")


def top_types(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_type").alias("TIPO_INCIDENTE"))
    return A.top_totals(parts, "TIPO_INCIDENTE")


def top_types_many(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_type").alias("TIPO_INCIDENTE"))
    return A.top_totals_many(parts, "TIPO_INCIDENTE")


def top_orders_many(spark, sf_dir):
    """The customers with most orders: a key with very many values."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("CLIENTE"))
    return A.top_totals_many(orders, "CLIENTE", n=25)


def date_bounds(spark, sf_dir):
    return A.date_bounds(event_times(spark, sf_dir))


def domain_values(spark, sf_dir):
    return A.domain(event_times(spark, sf_dir), "TIPO_INCIDENTE")


# --- filters ---------------------------------------------------------------


def _order_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("FECHA"),
        F.col("o_orderpriority").alias("LOCALIDAD"),
        F.col("o_orderstatus").alias("TIPO_INCIDENTE"),
    )


def filtered_daily(spark, sf_dir):
    request = ReportFilter("1996-01-01", "1998-12-31", "1-URGENT", ["F", "P"])
    return A.daily_trend(request.apply(_order_dates(spark, sf_dir)))


def open_range_daily(spark, sf_dir):
    return A.daily_trend(in_date_range(_order_dates(spark, sf_dir), start="2000-06-01"))


def empty_filter(spark, sf_dir):
    orders = _order_dates(spark, sf_dir)
    requests = {
        "none": ReportFilter("1890-01-01", "1890-12-31"),
        "some": ReportFilter("1996-01-01", "1996-12-31"),
    }
    return concat_tables(
        [is_empty(r.apply(orders)).withColumn("PEDIDO", F.lit(k)) for k, r in requests.items()]
    )


# --- joins and geography ---------------------------------------------------


def map_points_query(spark, sf_dir):
    return map_points(text_code_incidents(spark, sf_dir), localities(spark, sf_dir))


def _rounded(df):
    """Averages to six places: sums of doubles depend on their order."""
    return df.withColumns({c: F.round(c, 6) for c in ("X", "Y")})


def map_points_dim_first(spark, sf_dir):
    return _rounded(map_totals(incidents(spark, sf_dir), localities(spark, sf_dir)))


def map_points_keep_dimension(spark, sf_dir):
    return _rounded(
        map_totals(incidents(spark, sf_dir), localities(spark, sf_dir), keep_dimension=True)
    )


def map_join_kinds(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("NUMERO_INCIDENTE"),
        F.nullif("s_nationkey", F.lit(4)).cast("bigint").alias("CODIGO_LOCALIDAD"),
        F.substring("s_name", -1, 1).alias("LOCALIDAD"),
    )
    points = localities(spark, sf_dir)
    kinds = [
        _rounded(map_totals(suppliers, points, how=how)).withColumn("TIPO_JOIN", F.lit(how))
        for how in ("inner", "left", "right", "full")
    ]
    return concat_tables(kinds)


def map_has_xy(spark, sf_dir):
    points = map_points_query(spark, sf_dir)
    return map_has_points(points)


def small_side_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    return (
        join_small(lines, suppliers, "l_suppkey")
        .groupBy("s_nationkey")
        .agg(F.count(F.lit(1)).alias("TOTAL"), F.sum("l_quantity").alias("cantidad"))
    )


def _customer_documents(spark, sf_dir, key):
    """Customers as GeoJSON documents, with ``key`` as their code."""
    x, y = F.col("c_acctbal") / 4, F.col("c_nationkey") * 0.5
    in_geometry = F.col("c_mktsegment") == "BUILDING"
    feature = F.struct(
        F.struct(F.array(x, y).alias("coordinates")).alias("geometry"),
        F.struct(
            key.alias("Codigo_Localidad"),
            F.col("c_name").alias("LocNombre"),
            F.when(~in_geometry, x + 1).alias("POINT_X"),
            F.when(~in_geometry, y + 1).alias("POINT_Y"),
        ).alias("properties"),
    )
    return table(spark, sf_dir, "customer").select(
        F.to_json(F.struct(F.array(feature).alias("features"))).alias("documento")
    )


def geo_features(spark, sf_dir):
    """Customers written as GeoJSON documents and read as points."""
    return locality_points(parse_geojson(_customer_documents(spark, sf_dir, F.col("c_custkey")), "documento"))


def geo_files(spark, sf_dir):
    """The same from files, with the codes as text."""
    folder = scratch_folder(spark, "geojson")
    _customer_documents(spark, sf_dir, F.col("c_custkey").cast("string")).write.text(folder)
    return locality_points(read_geojson(spark, folder, multi_line=False))


def json_props(spark, sf_dir):
    props = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


# --- report ----------------------------------------------------------------


def _report(part: str, from_cube: bool = False) -> Query:
    def query(spark, sf_dir):
        rows = prepare_incidents(incidents(spark, sf_dir))
        points = localities(spark, sf_dir)
        if from_cube:
            rows, weight = incident_cube(rows), "TOTAL"
        else:
            weight = None
        return report(rows, points, REQUEST, weight, parts=[part])[part]

    return query


# --- scalars ---------------------------------------------------------------


def text_repair(spark, sf_dir):
    """Documents, with some letters broken the way a wrong decoding does it."""
    broken = F.replace(F.replace("text", F.lit("é"), F.lit("Ã©")), F.lit("ü"), F.lit("Â¡"))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", broken.alias("TEXTO"))
        .withColumn("TEXTO", text.repair_text("TEXTO"))
    )


def text_standard(spark, sf_dir):
    padded = F.concat(F.lit("\t  "), "text", F.lit("  \n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.standard_text(padded).alias("TEXTO")
    )


def label_map(spark, sf_dir):
    key = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "608")
        .when(F.col("o_orderpriority") == "2-HIGH", "SIN_DATO")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "FONTIBÓN")
        .otherwise(F.col("o_orderstatus"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", codes.map_label(key).alias("ETIQUETA")
    )


def priority_map(spark, sf_dir):
    first = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", codes.map_priority(first).alias("PRIORIDAD_FINAL")
    )


def code_standard(spark, sf_dir):
    key = F.col("c_nationkey")
    given = (
        F.when(key == 0, F.lit("USAQUEN"))
        .when(key == 1, F.lit(" engativax "))
        .when(key == 2, F.lit("NULL"))
        .when(key == 3, F.lit("7.5"))
        .when(key < 10, F.concat(F.lit("0"), key.cast("string")))
        .when(key < 20, F.concat(key.cast("string"), F.lit(".00")))
        .otherwise(F.concat(F.lit("NATION_"), key.cast("string")))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", codes.standard_code(given).alias("CODIGO")
    )


def normalized_codes(spark, sf_dir):
    rows = text_code_incidents(spark, sf_dir)
    return rows.select("NUMERO_INCIDENTE", codes.normalized_code("CODIGO_LOCALIDAD").alias("CODIGO"))


def null_tokens(spark, sf_dir):
    token = F.when(F.col("lang") == "es", "NaN").when(F.col("lang") == "fr", "Nan").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.null_tokens(token).alias("VALOR"), text.null_words(token).alias("PALABRA")
    )


def blank_to_null(spark, sf_dir):
    value = F.when(F.col("event_type") == "error", F.lit(" \t\n")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", text.blank_to_null(value).alias("VALOR"))


def lenient_int(spark, sf_dir):
    value = F.col("value").cast("string")
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", F.concat(F.lit("-"), value))
        .when(kind == "click", F.replace(value, F.lit("."), F.lit(",")))
        .when(kind == "view", F.concat(F.lit(" "), F.floor("value").cast("string"), F.lit(".0 ")))
        .when(kind == "signup", F.concat(value, F.lit("e2")))
        .otherwise(value)
    )
    return table(spark, sf_dir, "events").select("event_id", codes.lenient_int(written).alias("ENTERO"))


def safe_timestamp(spark, sf_dir):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.lit(" NaT "))
        .when(kind == "click", F.concat(F.lit("x"), written))
        .otherwise(F.concat(F.lit(" "), written))
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", dates.safe_timestamp(value).alias("TS_SAFE")).select(
        "event_id", wall_clock("TS_SAFE")
    )


def text_timestamp(spark, sf_dir):
    rows = raw_incidents(spark, sf_dir)
    parsed = rows.select(
        "NUMERO_INCIDENTE", dates.parse_timestamp("FECHA_INICIO_DESPLAZAMIENTO_MOVIL").alias("TS")
    )
    return parsed.select("NUMERO_INCIDENTE", wall_clock("TS"))


def text_timestamp_formats(spark, sf_dir):
    """Event times written in five formats, and read."""
    forms = ["yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "MM-dd-yyyy HH:mm", "MM/dd/yyyy HH:mm:ss.SSS", "MM/dd/yyyy"]
    kind = F.col("event_id") % len(forms)
    text_ = F.coalesce(*[F.when(kind == i, F.date_format("ts", f)) for i, f in enumerate(forms)])
    written = table(spark, sf_dir, "events").select("event_id", text_.alias("texto"))
    return written.select("event_id", dates.parse_timestamp("texto").alias("TS")).select("event_id", wall_clock("TS"))


def date_parts(spark, sf_dir):
    rows = prepare_incidents(event_times(spark, sf_dir))
    rows = rows.withColumn("DIA_SEMANA_EN", dates.weekday_en("FECHA"))
    return A.totals(rows, "FECHA", "HORA", "DOW", "DIA_SEMANA", "DIA_SEMANA_EN")


# --- tables ----------------------------------------------------------------


def synonym_coalesce(spark, sf_dir):
    status = F.col("o_orderstatus")
    variants = table(spark, sf_dir, "orders").select(
        F.when(status == "F", F.col("o_orderpriority")).alias("PRIORIDAD"),
        F.when(status == "O", F.lit(" ")).otherwise(status).alias("PRIORIDAD FINAL"),
        F.col("o_orderkey").cast("string").alias("NUMERO_INCIDENTE"),
        F.when(status == "P", F.lit("7")).alias("COD_LOCALIDAD"),
        F.lit("x").alias("Unnamed: 3"),
        F.lit("y").alias("OTRA"),
    )
    cleaned = variants.select(*[text.blank_to_null(F.col(f"`{c}`")).alias(c) for c in variants.columns])
    return project_expected(drop_unnamed(unify_synonyms(cleaned)))


def hetero_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    closed = F.col("o_orderstatus") == "F"
    return concat_tables(
        [
            orders.where(closed).select("o_orderkey", "o_orderpriority"),
            orders.where(~closed).select("o_totalprice", "o_orderkey"),
            orders.select("o_orderkey"),
        ]
    )


def clean_incidents(spark, sf_dir):
    """Raw text to typed incidents, all steps."""
    ts = "FECHA_INICIO_DESPLAZAMIENTO_MOVIL"
    raw = raw_incidents(spark, sf_dir)
    repaired = text.repair_columns(raw)
    return standardize(repaired).withColumn(ts, wall_clock(ts))


def reject_rows(spark, sf_dir):
    return rejects(raw_incidents(spark, sf_dir)).select("NUMERO_INCIDENTE", "MOTIVO")


def csv_ingest(spark, sf_dir):
    """Orders written as two kinds of CSV file into one folder, then ingested."""
    folder = scratch_folder(spark, "csv-ingest")
    orders = table(spark, sf_dir, "orders")
    closed = F.col("o_orderstatus") == "F"
    when = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    place = F.concat(F.lit("USAQUÉN; \""), "o_orderpriority", F.lit('"'))
    number = F.col("o_orderkey").cast("string").alias("NUMERO_INCIDENTE")

    def write(df, encoding):
        options = {"header": True, "sep": ";", "escape": '"', "encoding": encoding}
        df.write.mode("append").options(**options).csv(folder)

    write(
        orders.where(closed).select(
            number,
            when.alias("FECHA_DESPACHO_518"),
            F.lit("NULL").alias("COD_LOCALIDAD"),
            place.alias("LOCALIDAD"),
            F.lit("x").alias("OTRA"),
            F.col("o_orderpriority").alias("PRIORIDAD"),
        ),
        "UTF-8",
    )
    write(
        orders.where(~closed).select(
            F.concat(F.lit("línea 1\n"), "o_orderstatus").alias("TIPO_INCIDENTE"),
            F.col("o_orderpriority").alias("PRIORIDAD FINAL"),
            number,
            place.alias("LOCALIDAD"),
            F.lit(" ").alias("CODIGO DE LOCALIDAD"),
            F.col("o_custkey").cast("string").alias("EDAD"),
            when.alias("FECHA_INICIO_DESPLAZAMIENTO_MOVIL"),
        ),
        "ISO-8859-1",
    )
    return read_csv_folder(spark, folder).records


def csv_date_orders(spark, sf_dir):
    """Order dates written day first into one file and month first into another, read by each file's order."""
    folder = scratch_folder(spark, "csv-dates")
    orders = table(spark, sf_dir, "orders")
    closed = F.col("o_orderstatus") == "F"
    for rows, form in ((orders.where(closed), "dd/MM/yyyy HH:mm"), (orders.where(~closed), "MM/dd/yyyy HH:mm")):
        text_ = F.date_format("o_orderdate", form).alias("FECHA_DESPACHO_518")
        # one file for each order: the few rows of a small part might hold no date that tells
        rows.select(F.col("o_orderkey").cast("string").alias("NUMERO_INCIDENTE"), text_).coalesce(1).write.mode("append").options(header=True, sep=";").csv(folder)
    found = read_csv_folder(spark, folder, day_first_column=DAY_FIRST_COLUMN).records
    when = dates.parse_ordered_timestamp("FECHA_INICIO_DESPLAZAMIENTO_MOVIL", F.col(DAY_FIRST_COLUMN) == "1")
    return found.select("NUMERO_INCIDENTE", when.alias("TS")).select("NUMERO_INCIDENTE", wall_clock("TS"))


def malformed_records(spark, sf_dir):
    """Orders written with a field too many in every seventh record; these come back as they stood."""
    folder = scratch_folder(spark, "csv-malformed")
    surplus = F.when(F.col("o_orderkey") % 7 == 0, F.lit(";x")).otherwise(F.lit(""))
    line = F.concat("o_orderpriority", F.lit(";"), F.col("o_orderkey").cast("string"), surplus)
    lines = table(spark, sf_dir, "orders").select(line.alias("PRIORIDAD;NUMERO_INCIDENTE"))
    lines.write.options(header=True, sep="\x01").csv(folder)
    return read_csv_folder(spark, folder).malformed.select("REGISTRO")


def parquet_roundtrip(spark, sf_dir):
    path = write_parquet(event_times(spark, sf_dir), scratch_folder(spark, "parquet"))
    return A.daily_totals(read_parquet(spark, path))


def clustered_month(spark, sf_dir):
    """Events stored in order of their date, one month of them read."""
    rows = event_times(spark, sf_dir)
    path = write_clustered(rows, scratch_folder(spark, "clustered"))
    stored = in_date_range(read_parquet(spark, path, rows.schema), "2024-01-08", "2024-01-14")
    return A.totals(stored, "FECHA", "TIPO_INCIDENTE")


def bloom_lookup(spark, sf_dir):
    """Orders stored by date with Bloom filters on their number, three of them looked up."""
    rows = incidents(spark, sf_dir)
    path = write_clustered(rows, scratch_folder(spark, "bloom"), lookup={"NUMERO_INCIDENTE": 1_000_000})
    found = read_parquet(spark, path, rows.schema).where(F.col("NUMERO_INCIDENTE").isin("7", "33", "absent"))
    return found.select("NUMERO_INCIDENTE", "FECHA", "TIPO_INCIDENTE")


def footer_bounds_query(spark, sf_dir):
    """Date bounds and rows of the stored events, from file footers."""
    path = write_clustered(event_times(spark, sf_dir), scratch_folder(spark, "footers"))
    return stored_bounds(spark, path)


def published_totals(spark, sf_dir):
    """Two runs published one after the other; the totals of the last one."""
    config = {"base_path": scratch_folder(spark, "published")}
    rows = prepare_incidents(incidents(spark, sf_dir)).drop("TS_SAFE", "DOW")
    flat = {name: [] for name in AGGREGATE_TABLES}
    publish_tables(spark, rows.where("TIPO_INCIDENTE = 'F'"), config, partition_by=flat)
    publish_tables(spark, rows, config, partition_by=flat, cluster_by="FECHA")
    return _labelled_totals(spark, current_paths(spark, config))


def partition_roundtrip(spark, sf_dir):
    """Event rows in one directory per day and type, read for one week."""
    rows = event_times(spark, sf_dir)
    keys = ["FECHA", "TIPO_INCIDENTE"]
    path = write_partitioned(rows, scratch_folder(spark, "partitioned"), keys)
    stored = in_date_range(read_parquet(spark, path, rows.schema), "2024-01-08", "2024-01-14")
    return A.totals(stored, *keys)


def stored_totals(spark, sf_dir):
    """General table and five totals written, and all totals read back."""
    out = scratch_folder(spark, "tables")
    config = {"base_path": out, "data_procesada": "procesada", "data_dashboard": "dashboard"}
    rows = prepare_incidents(incidents(spark, sf_dir)).drop("TS_SAFE", "DOW")
    return _labelled_totals(spark, write_tables(spark, rows, config))


def _labelled_totals(spark, paths):
    """All stored totals, with their table's name and keys as text."""

    def labelled(name):
        keys = [F.col(k).cast("string") for k in AGGREGATE_TABLES[name][1]]
        first, second = (keys + [F.lit(None).cast("string")])[:2]
        return read_totals(spark, name, paths[name]).select(
            F.lit(name).alias("TABLA"), first.alias("CLAVE_1"), second.alias("CLAVE_2"), "TOTAL"
        )

    return concat_tables([labelled(n) for n in AGGREGATE_TABLES])


def stored_totals_append(spark, sf_dir):
    """Two runs that append to the same tables; their totals add up."""
    config = {"base_path": scratch_folder(spark, "tables")}
    rows = prepare_incidents(incidents(spark, sf_dir)).drop("TS_SAFE", "DOW")
    closed = F.col("TIPO_INCIDENTE") == "F"
    flat = {name: [] for name in AGGREGATE_TABLES}
    for part in (rows.where(closed), rows.where(~closed)):
        paths = write_tables(spark, part, config, "append", False, False, partition_by=flat)
    return A.totals(_labelled_totals(spark, paths), "TABLA", "CLAVE_1", "CLAVE_2", weight="TOTAL")


def merged_appends(spark, sf_dir):
    """Three runs that append to the same totals, then merged to one row per key."""
    config = {"base_path": scratch_folder(spark, "tables")}
    rows = prepare_incidents(incidents(spark, sf_dir)).drop("TS_SAFE", "DOW")
    kind = F.col("TIPO_INCIDENTE")
    layout = {"diario": [], "heatmap": ["DIA_SEMANA"]}
    for part in (rows.where(kind == "F"), rows.where(kind == "O"), rows.where(~kind.isin("F", "O") | kind.isNull())):
        paths = write_tables(spark, part, config, "append", False, False, partition_by=layout)
    merged = {n: merge_appended(spark, n, paths[n], layout.get(n)) for n in AGGREGATE_TABLES}
    return _labelled_totals(spark, merged)


def retyped_texts(spark, sf_dir):
    """Event rows as text, taken in and given their types again."""
    rows = prepare_incidents(event_times(spark, sf_dir)).select("FECHA", "HORA", "TIPO_INCIDENTE")
    texts = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
    return A.totals(retype(texts), "FECHA", "HORA")


def session_requests(spark, sf_dir):
    """A report session over a stored table: the number of incidents it keeps, beside the trend of one request."""
    rows = prepare_incidents(incidents(spark, sf_dir)).drop("TS_SAFE", "DOW")
    path = write_parquet(rows, scratch_folder(spark, "general"))
    with ReportSession(prepare_incidents(read_parquet(spark, path)), localities(spark, sf_dir)) as session:
        kept = session.materialize()
        trend = session.request(REQUEST)["trend"].withColumn("INCIDENTES", F.lit(kept).cast("bigint"))
        return read_parquet(spark, write_parquet(trend, scratch_folder(spark, "session")), trend.schema)


def spread_by_date(spark, sf_dir):
    """Rows laid out by date, hot dates over several tasks, then counted."""
    orders = _order_dates(spark, sf_dir)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return A.daily_totals(spread(orders, width, "FECHA", ways=4))


QUERIES: dict[str, Query] = {
    "daily_totals": daily_totals,
    "weekday_hour_totals": weekday_hour_totals,
    "weekday_hour_matrix": weekday_hour_matrix,
    "locality_totals": locality_totals,
    "type_totals": type_totals,
    "priority_type_totals": priority_type_totals,
    "priority_type_totals_not_null": priority_type_totals_not_null,
    "priority_type_rollup": priority_type_rollup,
    "top_localities": top_localities,
    "top_types": top_types,
    "top_types_many": top_types_many,
    "top_orders_many": top_orders_many,
    "date_bounds": date_bounds,
    "footer_bounds": footer_bounds_query,
    "domain_values": domain_values,
    "filtered_daily": filtered_daily,
    "open_range_daily": open_range_daily,
    "empty_filter": empty_filter,
    "map_points": map_points_query,
    "map_points_dim_first": map_points_dim_first,
    "map_points_keep_dimension": map_points_keep_dimension,
    "map_join_kinds": map_join_kinds,
    "map_has_xy": map_has_xy,
    "small_side_join": small_side_join,
    "geo_features": geo_features,
    "geo_files": geo_files,
    "json_props": json_props,
    "report_trend": _report("trend"),
    "report_heatmap": _report("heatmap"),
    "report_heatmap_matrix": _report("heatmap_matrix"),
    "report_top_localities": _report("top_localities"),
    "report_top_types": _report("top_types"),
    "report_hierarchy": _report("hierarchy"),
    "report_hierarchy_totals": _report("hierarchy_totals"),
    "report_map": _report("map"),
    "cube_trend": _report("trend", from_cube=True),
    "cube_hierarchy": _report("hierarchy", from_cube=True),
    "cube_map": _report("map", from_cube=True),
    "text_repair": text_repair,
    "text_standard": text_standard,
    "label_map": label_map,
    "priority_map": priority_map,
    "code_standard": code_standard,
    "normalized_codes": normalized_codes,
    "null_tokens": null_tokens,
    "blank_to_null": blank_to_null,
    "lenient_int": lenient_int,
    "safe_timestamp": safe_timestamp,
    "text_timestamp": text_timestamp,
    "text_timestamp_formats": text_timestamp_formats,
    "date_parts": date_parts,
    "synonym_coalesce": synonym_coalesce,
    "hetero_union": hetero_union,
    "clean_incidents": clean_incidents,
    "rejects": reject_rows,
    "csv_ingest": csv_ingest,
    "csv_date_orders": csv_date_orders,
    "malformed_records": malformed_records,
    "parquet_roundtrip": parquet_roundtrip,
    "clustered_month": clustered_month,
    "bloom_lookup": bloom_lookup,
    "published_totals": published_totals,
    "partition_roundtrip": partition_roundtrip,
    "stored_totals": stored_totals,
    "stored_totals_append": stored_totals_append,
    "merged_appends": merged_appends,
    "retyped_texts": retyped_texts,
    "session_requests": session_requests,
    "spread_by_date": spread_by_date,
}
