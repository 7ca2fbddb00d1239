import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from almenara.operators import aggregates as A
from almenara.operators.aggregates import one_set, totals, totals_together
from almenara.operators.clean import drop_unnamed, unify_synonyms
from almenara.operators.sinks import compact, spread, write_partitioned
from almenara.operators.standardize import rejects, standardize
from almenara.plans.tables import build, folder_of, load_raw, locality_map, merge_appended, retype, write_tables
from almenara.schema import AGGREGATE_TABLES, CLEAN_SCHEMA
from almenara.sources.tables import as_spark_frame, read_parquet, read_totals

RAW = """NUMERO_INCIDENTE;FECHA_DESPACHO_518;COD_LOCALIDAD;LOCALIDAD;EDAD;UNIDAD;GENERO;TIPO_INCIDENTE;PRIORIDAD;RECEPCION
CRU-1;2024-01-05 10:00:00;11;suba;25;AÃ‘OS;m;608;1;x
CRU-2;05/02/2024 11:00;USAQUÉN;USAQUÉN;25,5;años;F;613;CRITCA;
CRU-3;;;;;;;;;
"""


@pytest.fixture
def config(tmp_path):
    os.makedirs(tmp_path / "data/cruda")
    os.makedirs(tmp_path / "data/complementaria")
    (tmp_path / "data/cruda/enero.csv").write_text(RAW, encoding="utf-8")
    (tmp_path / "data/complementaria/localidades_xy.geojson").write_text(
        """{"type": "FeatureCollection",
 "features": [
  {"geometry": {"coordinates": [1.0, 2.0]}, "properties": {"Codigo_Localidad": 11, "POINT_X": 5.0, "POINT_Y": 6.0}},
  {"geometry": {"coordinates": [3.0, 4.0]}, "properties": {"Codigo_Localidad": 12}}
 ]}"""
    )
    return {"base_path": str(tmp_path)}


def test_folder_to_clean_table(spark, config):
    raw, broken, _ = load_raw(spark, config)
    clean = standardize(raw)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    got = {r[0]: tuple(r)[1:] for r in clean.collect()}
    assert got["CRU-1"] == (
        dt.datetime(2024, 1, 5, 10), 11, "SUBA", 25, "AÑOS", "MASCULINO", "HERIDO", "CRITICA", "X",
        dt.date(2024, 1, 5), 10, "Friday", "Viernes",
    )
    assert got["CRU-2"] == (
        dt.datetime(2024, 5, 2, 11), None, "USAQUEN", 25, "AÑOS", "FEMENINO", "INCONSCIENTE", "CRITICA", None,
        dt.date(2024, 5, 2), 11, "Thursday", "Jueves",
    )
    assert got["CRU-3"] == (None,) * 13
    assert [(r.NUMERO_INCIDENTE, r.MOTIVO) for r in broken.collect()] == [("CRU-2", "CODIGO_LOCALIDAD")]


def test_standardize_names_missing_columns(spark):
    with pytest.raises(ValueError, match="GENERO"):
        standardize(spark.createDataFrame([("a",)], "LOCALIDAD string"))
    with pytest.raises(ValueError):
        rejects(spark.createDataFrame([("a",)], "LOCALIDAD string"))


def test_cleaning_plans_have_no_shuffle_and_no_python(spark, config):
    raw, broken, _ = load_raw(spark, config)
    for df in (standardize(raw), broken):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_build_writes_all_tables(spark, config):
    paths = build(spark, config)
    assert set(paths) == {"general", "rejects", "malformed", *AGGREGATE_TABLES}
    assert [r.MOTIVO for r in read_parquet(spark, paths["rejects"]).collect()] == ["CODIGO_LOCALIDAD"]
    assert read_parquet(spark, paths["malformed"]).count() == 0
    general = read_parquet(spark, paths["general"])
    assert general.count() == 3
    for name in AGGREGATE_TABLES:
        totals = read_totals(spark, name, paths[name])
        assert totals.agg(F.sum("TOTAL")).first()[0] == 3
        assert all(f.dataType == t for f, t in zip(totals.schema, AGGREGATE_TABLES[name][1].values()))
    assert "__HIVE_DEFAULT_PARTITION__" in str(os.listdir(paths["localidad"]))
    # building again replaces, whatever the mode
    general = read_parquet(spark, build(spark, config, mode="append")["general"])
    assert general.count() == 3
    got = locality_map(spark, general, config).orderBy("CODIGO_LOCALIDAD").collect()
    assert [tuple(r) for r in got] == [(None, 0, 3.0, 4.0, None), (11, 1, 5.0, 6.0, "SUBA")]


def test_write_modes_and_layout(spark, config):
    rows = spark.createDataFrame([("1", "1", "x")], "LOCALIDAD string, HORA string, DIA_SEMANA string").withColumns(
        {"FECHA": F.lit("2024-01-05 00:00:00"), "TIPO_INCIDENTE": F.lit("1"), "PRIORIDAD_FINAL": F.lit(None).cast("string")}
    )
    for _ in range(2):
        paths = write_tables(spark, rows, config, "append", False, False, partition_by={"diario": [], "heatmap": ["HORA"]})
    assert read_parquet(spark, paths["general"]).count() == 2
    # each run appends the count of its own rows; the key stays text
    places = read_totals(spark, "localidad", paths["localidad"]).collect()
    assert sorted(tuple(r) for r in places) == [("1", 1), ("1", 1)]
    assert not any("=" in f for f in os.listdir(paths["diario"]))
    assert any(f == "HORA=1" for f in os.listdir(paths["heatmap"]))
    daily = read_totals(spark, "diario", paths["diario"])
    assert {r.FECHA for r in daily.collect()} == {dt.date(2024, 1, 5)}


def test_refresh_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, ["k"])
    write_partitioned(spark.createDataFrame([("b", 2)], "k string, v int"), path, ["k"], refresh_only=True)
    got = read_parquet(spark, path, spark.createDataFrame([], "v int, k string").schema)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "b")]


def test_few_files_per_directory_and_shared_out(spark, tmp_path):
    rows = spark.range(0, 4000, numPartitions=8).select((F.col("id") % 5).alias("k"), "id")
    path = write_partitioned(rows, str(tmp_path / "r"), ["k"])
    for k in range(5):
        assert len([f for f in os.listdir(f"{path}/k={k}") if f.endswith(".parquet")]) == 1
    grouped = rows.groupBy("k").count()
    path = write_partitioned(grouped, str(tmp_path / "g"), ["k"], tasks=4)
    parts = {f.split("-")[1] for k in range(5) for f in os.listdir(f"{path}/k={k}") if f.endswith(".parquet")}
    assert len(parts) > 1  # more than one task wrote


def test_spread_splits_a_hot_key(spark):
    rows = spark.range(10000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), "id")
    sizes = spread(rows, 16, "k", ways=8).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 2500
    assert spread(rows, 3, "k").rdd.getNumPartitions() == 3
    assert compact(rows, 2).rdd.getNumPartitions() == 2
    assert compact(rows).count() == 10000


def test_frame_intake(spark):
    pdf = pd.DataFrame({"a": pd.array([1, None], dtype="Int64"), "b": ["x", float("nan")], "c": [1.5, 2.0]})
    got = as_spark_frame(spark, pdf)
    assert got.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert [tuple(r) for r in got.collect()] == [("1", "x", "1.5"), (None, None, "2.0")]
    assert as_spark_frame(spark, got) is got
    with pytest.raises(TypeError):
        as_spark_frame(spark, [1])


def test_retype_only_present_columns(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00", "7,5")], "FECHA string, EDAD string")
    assert [tuple(r) for r in retype(df).collect()] == [(dt.date(2024, 1, 5), 7)]
    bad = spark.createDataFrame([("NaT", "x")], "FECHA string, EDAD string")
    assert [tuple(r) for r in retype(bad).collect()] == [(None, None)]
    other = spark.createDataFrame([(1,)], "x int")
    assert retype(other) is other


def test_folder_of():
    assert folder_of({"base_path": "/b/"}, "data_cruda") == "/b/data/cruda"
    assert folder_of({"data_cruda": "s3a://x/y/"}, "data_cruda") == "s3a://x/y"
    with pytest.raises(ValueError):
        folder_of({}, "data_cruda")


def test_drop_unnamed_and_dotted_synonyms(spark):
    df = spark.createDataFrame([("1", None, "3", "4")], "`Unnamed: 0` string, `P` string, `P.1` string, z string")
    got = unify_synonyms(drop_unnamed(df), {"Q": ["P", "P.1"]})
    assert got.columns == ["z", "Q"] and tuple(got.first()) == ("4", "3")


def test_hierarchy_parents_are_sums(spark):
    leaves = A.priority_type_totals(
        spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "x")], "PRIORIDAD_FINAL string, TIPO_INCIDENTE string")
    )
    got = sorted((tuple(r) for r in A.hierarchy_totals(leaves).collect()), key=str)
    assert got == sorted(
        [("A", "x", 0, 1), ("A", "y", 0, 1), ("B", "x", 0, 1), ("A", None, 1, 2), ("B", None, 1, 1), (None, None, 3, 3)],
        key=str,
    )


def test_totals_together_equal_each_alone(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", None, "x"), (None, 1, "x"), ("a", 1, None)], "p string, q int, r string")
    sets = [("p",), ("q", "r"), ("r", "p"), ("p", "q", "r")]
    together = totals_together(rows, sets)
    for keys in sets:
        alone = sorted(map(str, totals(rows, *keys).collect()))
        assert sorted(map(str, one_set(together, *keys).collect())) == alone
    assert one_set(totals_together(rows.limit(0), sets), "p").count() == 0


def test_one_scan_of_the_general_table_for_all_totals(spark, tmp_path):
    rows = spark.createDataFrame([("d", "1", "l", "t", None)] * 3, "DIA_SEMANA string, HORA string, LOCALIDAD string, TIPO_INCIDENTE string, PRIORIDAD_FINAL string").withColumn("FECHA", F.lit("2024-01-05"))
    rows.write.parquet(str(tmp_path / "g"))
    together = totals_together(read_parquet(spark, str(tmp_path / "g")), [keys for _, keys in AGGREGATE_TABLES.values()])
    assert together._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert together.agg(F.sum("TOTAL")).first()[0] == 3 * len(AGGREGATE_TABLES)


def test_appended_totals_merge_in_touched_partitions_only(spark, config):
    frame = lambda *places: spark.createDataFrame([(p, 1) for p in places], "LOCALIDAD string, HORA int").withColumns(
        {"FECHA": F.lit("2024-01-05").cast("date"), "DIA_SEMANA": F.lit("LUNES"), "TIPO_INCIDENTE": F.lit("t"), "PRIORIDAD_FINAL": F.lit(None).cast("string")}
    )
    layout = {"diario": []}
    for part in (frame("a", "b", None), frame("b", None), frame("c")):
        paths = write_tables(spark, part, config, "append", False, False, partition_by=layout)
    untouched = set(os.listdir(f"{paths['localidad']}/LOCALIDAD=a"))
    for name in AGGREGATE_TABLES:
        for _ in range(2):  # the second time there is nothing to do
            merge_appended(spark, name, paths[name], layout.get(name))
        rows = read_totals(spark, name, paths[name]).collect()
        assert len({r[:-1] for r in map(tuple, rows)}) == len(rows) and sum(r.TOTAL for r in rows) == 6
    assert {(r.LOCALIDAD, r.TOTAL) for r in read_totals(spark, "localidad", paths["localidad"]).collect()} == {("a", 1), ("b", 2), (None, 2), ("c", 1)}
    assert set(os.listdir(f"{paths['localidad']}/LOCALIDAD=a")) == untouched


def test_dates_of_a_day_first_file_reach_the_clean_table(spark, config):
    raw, broken, _ = load_raw(spark, config)
    assert "DIA_PRIMERO" in raw.columns and "DIA_PRIMERO" not in broken.columns
    flagged = raw.limit(1).withColumns({"FECHA_INICIO_DESPLAZAMIENTO_MOVIL": F.lit("05/02/2024"), "DIA_PRIMERO": F.lit("1")})
    assert standardize(flagged).first().FECHA == dt.date(2024, 2, 5)
    assert standardize(flagged.withColumn("DIA_PRIMERO", F.lit("0"))).first().FECHA == dt.date(2024, 5, 2)
