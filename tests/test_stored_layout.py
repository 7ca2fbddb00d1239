"""Clustered tables, Bloom filters, footers, published runs and top lists over many keys."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from almenara.operators.aggregates import top_totals, top_totals_many
from almenara.operators.sinks import write_clustered, write_parquet
from almenara.plans.publish import current_paths, publish_tables, published, retired
from almenara.schema import AGGREGATE_TABLES
from almenara.sources.tables import read_parquet, read_totals, stored_bounds

FLAT = {name: [] for name in AGGREGATE_TABLES}


def dated(spark, n=40_000, days=200):
    """Rows in no order of their date, a third of them on one day; numbers in no order either."""
    day = F.when(F.col("id") % 3 == 0, F.lit(17)).otherwise(F.pmod(F.xxhash64("id"), F.lit(days))).cast("int")
    return spark.range(n).select(
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("FECHA"),
        F.sha1(F.col("id").cast("string")).alias("NUMERO_INCIDENTE"),
        F.col("id"),
    )


def scanned_rows(df):
    """Rows that the table scan gave to the plan, of a plan without adaptive execution."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        leaves = execution.executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_clustered_dates_are_skipped(spark, tmp_path):
    rows = dated(spark)
    path = write_clustered(rows, str(tmp_path / "t"), partitions=16)
    stored = read_parquet(spark, path, rows.schema)
    assert stored.count() == 40_000 and stored.exceptAll(rows).isEmpty()
    groups = [(g.statistics.min, g.statistics.max, g.num_values) for f in glob.glob(f"{path}/*.parquet") for m in [pq.ParquetFile(f).metadata] for g in [m.row_group(i).column(0) for i in range(m.num_row_groups)]]
    assert max(n for _, _, n in groups) < 40_000 / 16 * 2, "the hot day fills several tasks"
    late = stored.where("FECHA between date'2024-06-01' and date'2024-06-07'")
    wanted = rows.where("FECHA between date'2024-06-01' and date'2024-06-07'").count()
    assert late.count() == wanted
    assert scanned_rows(late) < 40_000 / 5
    plain = read_parquet(spark, write_parquet(rows.repartition(16), str(tmp_path / "plain")), rows.schema)
    assert scanned_rows(plain.where("FECHA between date'2024-06-01' and date'2024-06-07'")) == 40_000


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rows = dated(spark)
    path = write_clustered(rows, str(tmp_path / "t"), partitions=16, lookup={"NUMERO_INCIDENTE": 10_000})
    stored = read_parquet(spark, path, rows.schema)
    one = rows.where("id = 4321").first()
    found = stored.where(F.col("NUMERO_INCIDENTE") == one.NUMERO_INCIDENTE)
    assert [r.id for r in found.collect()] == [4321]
    assert scanned_rows(found) < 40_000 / 4
    plain = read_parquet(spark, write_clustered(rows, str(tmp_path / "plain"), partitions=16), rows.schema)
    assert scanned_rows(plain.where(F.col("NUMERO_INCIDENTE") == one.NUMERO_INCIDENTE)) == 40_000


def test_clustered_null_dates_and_empty_table(spark, tmp_path):
    rows = dated(spark, 300).withColumn("FECHA", F.when(F.col("id") % 4 > 0, F.col("FECHA")))
    path = write_clustered(rows, str(tmp_path / "nulls"), partitions=4)
    assert read_parquet(spark, path, rows.schema).exceptAll(rows).isEmpty()
    nothing = write_clustered(rows.where("id < 0"), str(tmp_path / "none"))
    assert read_parquet(spark, nothing, rows.schema).count() == 0
    alone = write_clustered(rows.select("FECHA"), str(tmp_path / "alone"))
    assert read_parquet(spark, alone).count() == 300


def test_bounds_from_footers(spark, tmp_path):
    rows = dated(spark)
    path = write_clustered(rows, str(tmp_path / "t"), partitions=4)
    plan = stored_bounds(spark, path)._jdf.queryExecution().toString()
    assert "PushedAggregation: [MIN(FECHA), MAX(FECHA), COUNT(*)]" in plan
    want = rows.agg(F.min("FECHA"), F.max("FECHA"), F.count(F.lit(1))).first()
    assert tuple(stored_bounds(spark, path).first()) == tuple(want)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_bounds_where_footers_do_not_tell(spark, tmp_path):
    rows = dated(spark, 400).withColumn("FECHA", F.when(F.col("id") % 2 > 0, F.col("FECHA")))
    path = write_clustered(rows, str(tmp_path / "nulls"), partitions=8)
    want = rows.agg(F.min("FECHA"), F.max("FECHA"), F.count(F.lit(1))).first()
    assert tuple(stored_bounds(spark, path).first()) == tuple(want)
    nothing = write_clustered(rows.where("id < 0"), str(tmp_path / "none"))
    assert tuple(stored_bounds(spark, nothing).first()) == (None, None, 0)


def small_incidents(spark, types):
    return spark.createDataFrame(
        [(None, 8, "Lunes", "SUBA", t, "ALTA") for t in types],
        "FECHA date, HORA int, DIA_SEMANA string, LOCALIDAD string, TIPO_INCIDENTE string, PRIORIDAD_FINAL string",
    )


def test_failed_run_leaves_the_published_tables(spark, tmp_path):
    config = {"base_path": str(tmp_path)}
    assert current_paths(spark, config) == {}
    first = publish_tables(spark, small_incidents(spark, ["A", "A", "B"]), config, partition_by=FLAT)
    assert current_paths(spark, config) == first
    with pytest.raises(Exception, match="no_such_key|UNRESOLVED_COLUMN"):  # after the general table and two totals
        publish_tables(spark, small_incidents(spark, ["C"]), config, partition_by={**FLAT, "localidad": ["no_such_key"]})
    assert current_paths(spark, config) == first
    got = read_totals(spark, "tipo_incidente", first["tipo_incidente"]).collect()
    assert sorted(tuple(r) for r in got) == [("A", 2), ("B", 1)]
    second = publish_tables(spark, small_incidents(spark, ["C"]), config, partition_by=FLAT)
    assert current_paths(spark, config) == second
    assert [tuple(r) for r in read_totals(spark, "tipo_incidente", second["tipo_incidente"]).collect()] == [("C", 1)]
    # the old version can still be read, and is the one to delete
    assert read_parquet(spark, first["general"]).count() == 3
    assert {r.CARPETA for r in retired(spark, config, keep=1).collect()} == set(first.values())
    assert published(spark, config).select("NUMERO").distinct().count() == 2


@pytest.mark.parametrize("buckets", [1, 8, 512])
@pytest.mark.parametrize("n", [1, 5, 60, 2000])
def test_top_list_over_many_keys_is_exact(spark, buckets, n):
    """Few large keys over many small ones, ties at the limit, nulls."""
    skewed = F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.floor(F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)) / 31.0, 2)))
    rows = spark.range(5000).select(skewed.cast("bigint").alias("k"))
    assert top_totals_many(rows, "k", n, buckets).collect() == top_totals(rows, "k", n).collect()


def test_top_list_of_few_hot_keys_and_of_nothing(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 10).otherwise(F.col("id")).alias("k"))
    assert top_totals_many(rows, "k", 3).collect() == top_totals(rows, "k", 3).collect()
    assert top_totals_many(rows.limit(0), "k", 3).collect() == []
