"""GeoJSON points: the locality dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.functions.text import as_column
from almenara.schema import FEATURE_COLLECTION


def feature_points(collections: DataFrame) -> DataFrame:
    """One row per feature: its code and point properties and its coordinates."""
    feature = F.explode("features")
    return collections.select(feature.alias("feature")).select(
        "feature.properties.Codigo_Localidad",
        "feature.properties.POINT_X",
        "feature.properties.POINT_Y",
        "feature.geometry.coordinates",
    )


def read_geojson(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Features of GeoJSON documents.

    ``multi_line`` takes each file as one document; without it each line is a
    document, which splits over tasks.
    """
    documents = spark.read.schema(FEATURE_COLLECTION).option("multiLine", multi_line).json(path)
    return feature_points(documents)


def parse_geojson(df: DataFrame, text: Column | str) -> DataFrame:
    """Features of GeoJSON documents held in a text column."""
    parsed = F.from_json(as_column(text), FEATURE_COLLECTION)
    return feature_points(df.select(parsed.alias("d")).select("d.features"))


def locality_points(features: DataFrame) -> DataFrame:
    """``Codigo_Localidad, X, Y``; the point property, else the geometry.

    Codes and point properties may be numbers or text; what is no number is null.
    """
    x, y = (F.col(c).try_cast("double") for c in ("POINT_X", "POINT_Y"))
    return features.select(
        F.col("Codigo_Localidad").try_cast("bigint").alias("Codigo_Localidad"),
        F.coalesce(x, F.get("coordinates", F.lit(0))).alias("X"),
        F.coalesce(y, F.get("coordinates", F.lit(1))).alias("Y"),
    )


def read_localities(spark: SparkSession, path: str) -> DataFrame:
    return locality_points(read_geojson(spark, path))
