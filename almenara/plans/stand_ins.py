"""Incident tables derived from the star-schema tables.

Orders stand for incidents: the order is the incident number, its status the
type, its priority the priority; the customer's nation is the locality. Some
values are made null, misspelt or oddly written so that the operators have
something to do. Every row of the source tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_time() -> Column:
    """Order dates carry no time of day; one is made from the key."""
    hours = F.pmod("o_orderkey", F.lit(24)).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)


def located_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation of their customer.

    No hints: the optimizer broadcasts what is small, and adaptive execution
    splits the partitions of a customer with very many orders.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(homes, F.col("o_custkey") == F.col("c_custkey"))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed incident table with some null localities and priorities."""
    return located_orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("NUMERO_INCIDENTE"),
        order_time().alias("FECHA_INICIO_DESPLAZAMIENTO_MOVIL"),
        F.col("c_nationkey").cast("bigint").alias("CODIGO_LOCALIDAD"),
        F.nullif("n_name", F.lit("NATION_7")).alias("LOCALIDAD"),
        F.col("o_orderstatus").alias("TIPO_INCIDENTE"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("PRIORIDAD_FINAL"),
        F.to_date("o_orderdate").alias("FECHA"),
    )


def text_code_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``incidents``, with the code as untidy text."""
    code = F.col("CODIGO_LOCALIDAD").cast("string")
    return incidents(spark, sf_dir).withColumn(
        "CODIGO_LOCALIDAD",
        F.when(F.col("CODIGO_LOCALIDAD") == 5, F.lit(" NaN "))
        .when(F.col("TIPO_INCIDENTE") == "P", F.concat(code, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), code)),
    )


def localities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per code. Codes run from 1, so code 0 has no point and the last
    code no incidents."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        (key + 1).cast("bigint").alias("Codigo_Localidad"),
        (key * 1.5 - 74.25).alias("X"),
        (key * 0.25 + 4.5).alias("Y"),
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as incidents without a place."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("FECHA"),
        F.hour("ts").alias("HORA"),
        F.col("ts").alias("FECHA_INICIO_DESPLAZAMIENTO_MOVIL"),
        F.col("event_type").alias("TIPO_INCIDENTE"),
    )


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text incident table with the usual disorder in it."""
    status = F.col("o_orderstatus")
    time = order_time()
    code = F.col("c_nationkey").cast("string")
    day_first = (status == "P") & (F.dayofmonth("o_orderdate") > 12)
    return located_orders(spark, sf_dir).select(
        F.concat(F.lit(" n"), F.col("o_orderkey").cast("string")).alias("NUMERO_INCIDENTE"),
        F.when(status == "O", F.date_format(time, "M/d/yyyy H:mm"))
        .when(day_first, F.date_format(time, "dd/MM/yyyy HH:mm:ss"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("sin fecha"))
        .otherwise(F.date_format(time, "yyyy-MM-dd HH:mm:ss"))
        .alias("FECHA_INICIO_DESPLAZAMIENTO_MOVIL"),
        F.when(F.col("c_nationkey") == 3, F.lit("la candelaria"))
        .when(F.col("c_nationkey") == 4, F.lit("USAQUÉN"))
        .when(status == "O", F.concat(code, F.lit(".0")))
        .otherwise(F.lpad(code, 3, "0"))
        .alias("CODIGO_LOCALIDAD"),
        F.when(F.col("c_nationkey") == 10, F.lit("EngativÃ¡ "))
        .when(F.col("c_nationkey") == 9, F.lit("FONTIB¢N"))
        .when(F.col("c_nationkey") == 8, F.lit("sin_dato"))
        .otherwise(F.col("n_name"))
        .alias("LOCALIDAD"),
        F.when(status == "F", F.lit("25,5"))
        .when(status == "O", F.lit("-3"))
        .otherwise(F.lit("007.0"))
        .alias("EDAD"),
        F.lit("AÃ‘OS").alias("UNIDAD"),
        F.when(status == "F", F.lit("f")).otherwise(F.lit(" m")).alias("GENERO"),
        F.when(status == "F", F.lit("608")).otherwise(F.concat(F.lit("Tipo "), status)).alias("TIPO_INCIDENTE"),
        F.substring("o_orderpriority", 1, 1).alias("PRIORIDAD_FINAL"),
        F.lit("¿Qué? â€¢").alias("RECEPCION"),
    )
