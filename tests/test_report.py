import datetime as dt

import pytest
from pyspark.sql import functions as F

from almenara.operators import joins as J
from almenara.operators.filters import ReportFilter, equals_or_all, in_list
from almenara.plans.report import ReportSession, incident_cube, prepare_incidents, report
from almenara.plans.stand_ins import incidents, localities
from almenara.plans.tables import write_tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark, sf_dir):
    return prepare_incidents(incidents(spark, sf_dir)).drop("TS_SAFE", "DOW").cache()


@pytest.fixture(scope="module")
def stored(spark, facts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("inc") / "incidentes")
    facts.write.parquet(path)
    return spark.read.parquet(path)


def test_cube_equals_rows(spark, sf_dir, facts):
    points = localities(spark, sf_dir)
    for request in (
        ReportFilter(),
        ReportFilter("1996-01-01", dt.date(1997, 6, 30), "NATION_3", ["F"]),
        ReportFilter(locality="NATION_1", types=[]),
    ):
        direct = report(facts, points, request)
        cubed = report(incident_cube(facts), points, request, weight="TOTAL")
        assert direct.keys() == cubed.keys()
        for name in direct:
            assert rows(direct[name]) == rows(cubed[name]), name


def test_totals_add_up(spark, sf_dir, facts):
    tables = report(facts, localities(spark, sf_dir), ReportFilter())
    n = facts.count()
    assert tables["trend"].agg(F.sum("TOTAL")).first()[0] == n
    assert tables["heatmap"].agg(F.sum("TOTAL")).first()[0] == n
    assert tables["map"].agg(F.sum("TOTAL")).first()[0] == n
    parents = tables["hierarchy_totals"].where("NIVEL = 1").agg(F.sum("TOTAL")).first()[0]
    assert parents == tables["hierarchy"].agg(F.sum("TOTAL")).first()[0]


def test_filters_reach_the_scan(spark, sf_dir, stored):
    request = ReportFilter("1996-01-01", "1996-12-31", "NATION_3", ["F", "O"])
    prepared = prepare_incidents(stored)
    text = plan(report(prepared, localities(spark, sf_dir), request, parts=["trend"])["trend"])
    pushed = text[text.index("PushedFilters") :]
    for needed in ("GreaterThanOrEqual(FECHA", "LessThanOrEqual(FECHA", "EqualTo(LOCALIDAD", "In(TIPO_INCIDENTE"):
        assert needed in pushed
    assert "ReadSchema: struct<LOCALIDAD:string,TIPO_INCIDENTE:string,FECHA:date>" in text


def test_top_list_plan(spark, sf_dir, stored):
    text = plan(report(prepare_incidents(stored), localities(spark, sf_dir), parts=["top_types"])["top_types"])
    assert "TakeOrderedAndProject" in text and "Python" not in text


def test_map_joins_counts_not_rows(spark, sf_dir, stored):
    text = plan(report(prepare_incidents(stored), localities(spark, sf_dir), parts=["map"])["map"])
    assert "BroadcastHashJoin" in text
    # the exchange of incidents lies below the join and carries one row per code and task
    assert text.index("BroadcastHashJoin") < text.index("partial_count")


def test_partitioned_totals_are_pruned(spark, stored, tmp_path):
    paths = write_tables(spark, stored.limit(500), {"base_path": str(tmp_path)})
    daily = spark.read.parquet(paths["diario"]).where("FECHA >= '1998-01-01'")
    assert "PartitionFilters: [isnotnull(FECHA" in plan(daily)


def test_session_over_stored_tables(spark, stored, tmp_path):
    config = {"base_path": str(tmp_path)}
    write_tables(spark, stored.limit(300), config)
    folder = tmp_path / "data/complementaria"
    folder.mkdir(parents=True)
    (folder / "localidades_xy.geojson").write_text('{"features": [{"properties": {"Codigo_Localidad": 3, "POINT_X": 1.0, "POINT_Y": 2.0}}]}')
    with ReportSession.open(spark, config) as session:
        assert session.materialize() == 300
        assert session.cube.is_cached
        low, high = session.bounds().first()
        assert low < high
        types = [r[0] for r in session.types_domain().collect()]
        assert types == sorted(types) and set(types) == {"F", "O", "P"}
        places = [r[0] for r in session.localities_domain().collect()]
        assert None not in places and places == sorted(places)
        assert session.request(ReportFilter("1900-01-01", "1900-01-02")) is None
        tables = session.request(ReportFilter(types=types))
        assert tables["map_has_points"].first()[0] is True
        assert tables["trend"].agg(F.sum("TOTAL")).first()[0] == 300
    assert not session.cube.is_cached


def test_required_columns(spark):
    with pytest.raises(ValueError, match="FECHA"):
        prepare_incidents(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError, match="momento"):
        prepare_incidents(spark.createDataFrame([("2024-01-01",)], "FECHA string"), "momento")


def test_prepare_from_text(spark):
    df = spark.createDataFrame([("2024-01-05", "2024-01-05 10:30:00"), ("x", "NaT")], "FECHA string, ts string")
    got = rows(prepare_incidents(df, "ts").select("FECHA", "HORA", "DOW", "DIA_SEMANA"))
    assert got == sorted([(dt.date(2024, 1, 5), 10, 6, "Viernes"), (None, None, None, None)], key=str)


def test_no_filter_values(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    for value in (None, "", "TODAS"):
        assert equals_or_all(df, "c", value) is df
    for value in (None, [], "a"):
        assert in_list(df, "c", value) is df


# --- the map joins against joining the incidents themselves -----------------


def golden(spark):
    inc = spark.createDataFrame(
        [(1, "a", "L1"), (1, "b", None), (9, "c", "L9"), (None, "d", "L0"), (2, None, "L2")],
        "CODIGO_LOCALIDAD bigint, NUMERO_INCIDENTE string, LOCALIDAD string",
    )
    dim = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0), (3, 5.0, 6.0)], "Codigo_Localidad bigint, X double, Y double")
    return inc, dim


def test_dimension_first_golden(spark):
    inc, dim = golden(spark)
    assert rows(J.map_totals(inc, dim)) == sorted(
        [(None, 0, 5.0, 6.0, None), (1, 2, 1.0, 2.0, "L1"), (2, 0, 3.0, 4.0, "L2")], key=str
    )
    assert rows(J.map_totals(inc, dim, keep_dimension=True)) == sorted(
        [(3, 0, 5.0, 6.0, None), (1, 2, 1.0, 2.0, "L1"), (2, 0, 3.0, 4.0, "L2")], key=str
    )


@pytest.mark.parametrize("how", sorted(J.JOIN_KINDS))
@pytest.mark.parametrize("text_codes", [False, True])
def test_dimension_first_brute_force(spark, how, text_codes):
    inc, dim = golden(spark)
    dim = dim.union(spark.createDataFrame([(1, 7.0, None), (None, 8.0, 9.0), (4, 6.5, 1.0)], dim.schema))
    if text_codes:
        inc = inc.withColumn("CODIGO_LOCALIDAD", F.concat(F.col("CODIGO_LOCALIDAD").cast("string"), F.lit(".0")))
        inc = inc.union(spark.createDataFrame([("4", "e", "L4")], "c string, n string, l string"))
    inc = inc.withColumnRenamed("CODIGO_LOCALIDAD", "CODIGO")
    joined = dim.join(inc, dim.Codigo_Localidad.cast("string") == inc.CODIGO.cast("string"), how)
    want = joined.groupBy("CODIGO").agg(
        F.count("NUMERO_INCIDENTE").alias("TOTAL"), F.avg("X"), F.avg("Y"), F.min("LOCALIDAD")
    )
    assert rows(J.map_totals(inc, dim, "CODIGO", how=how)) == rows(want)


def test_join_kind_is_checked(spark):
    with pytest.raises(ValueError, match="anti"):
        J.map_totals(*golden(spark), how="anti")


def test_small_joins_start_no_job_and_broadcast_by_measure(spark):
    small = spark.createDataFrame([(i, "x" * 10) for i in range(50)], "k int, v string")
    large = spark.range(1000).select((F.col("id") % 60).cast("int").alias("k"))
    spark.sparkContext.setJobGroup("planning", "")
    joined = J.join_small(large, small, "k")
    J.map_points(*golden(spark))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    joined = joined.groupBy("v").count()
    assert joined.agg(F.sum("count")).first()[0] == 1000
    joined.collect()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_map_plans_do_not_sort_incidents(spark):
    """Smallest labels are sought among counts: below the first exchange there is no sort."""
    inc, dim = golden(spark)
    for df in (J.map_points(inc, dim), J.map_totals(inc, dim)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [x.strip(" :+-") for x in plan.splitlines()]
        lowest = [x.lstrip("*(0123456789) ") for x in lines if "partial_count" in x]
        assert lowest and all(x.startswith("HashAggregate") for x in lowest)
