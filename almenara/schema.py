"""Table schemas, used for explicit (never inferred) reads."""

from __future__ import annotations

from pyspark.sql import types as T

TIMESTAMP_COLUMN = "FECHA_INICIO_DESPLAZAMIENTO_MOVIL"
LABEL_COLUMNS = ["LOCALIDAD", "GENERO", "UNIDAD", "TIPO_INCIDENTE", "PRIORIDAD_FINAL"]

#: columns standardisation cannot do without
REQUIRED_COLUMNS = ["CODIGO_LOCALIDAD", *LABEL_COLUMNS, "EDAD", TIMESTAMP_COLUMN]

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("NUMERO_INCIDENTE", T.StringType()),
        T.StructField(TIMESTAMP_COLUMN, T.TimestampType()),
        T.StructField("CODIGO_LOCALIDAD", T.LongType()),
        T.StructField("LOCALIDAD", T.StringType()),
        T.StructField("EDAD", T.IntegerType()),
        T.StructField("UNIDAD", T.StringType()),
        T.StructField("GENERO", T.StringType()),
        T.StructField("TIPO_INCIDENTE", T.StringType()),
        T.StructField("PRIORIDAD_FINAL", T.StringType()),
        T.StructField("RECEPCION", T.StringType()),
        T.StructField("FECHA", T.DateType()),
        T.StructField("HORA", T.IntegerType()),
        T.StructField("DIA_SEMANA_EN", T.StringType()),
        T.StructField("DIA_SEMANA", T.StringType()),
    ]
)

#: stored totals: table key -> (folder, group keys with their types)
AGGREGATE_TABLES = {
    "diario": ("agg_diario", {"FECHA": T.DateType()}),
    "heatmap": ("agg_heatmap", {"DIA_SEMANA": T.StringType(), "HORA": T.IntegerType()}),
    "localidad": ("agg_localidad", {"LOCALIDAD": T.StringType()}),
    "tipo_incidente": ("agg_tipo_incidente", {"TIPO_INCIDENTE": T.StringType()}),
    "sunburst": (
        "agg_prioridad_tipo",
        {"PRIORIDAD_FINAL": T.StringType(), "TIPO_INCIDENTE": T.StringType()},
    ),
}


def aggregate_schema(name: str) -> T.StructType:
    """Schema to read the stored totals table ``name`` back with."""
    keys = AGGREGATE_TABLES[name][1]
    fields = [T.StructField("TOTAL", T.LongType())]
    return T.StructType(fields + [T.StructField(k, t) for k, t in keys.items()])


#: code and point are read as text: files have them quoted or not
FEATURE_PROPERTIES = T.StructType(
    [
        T.StructField("OBJECTID", T.LongType()),
        T.StructField("LocNombre", T.StringType()),
        T.StructField("LocAAdmini", T.StringType()),
        T.StructField("LocArea", T.DoubleType()),
        T.StructField("LocCodigo", T.StringType()),
        T.StructField("SHAPE_Leng", T.DoubleType()),
        T.StructField("Codigo_Localidad", T.StringType()),
        T.StructField("ORIG_FID", T.LongType()),
        T.StructField("POINT_X", T.StringType()),
        T.StructField("POINT_Y", T.StringType()),
    ]
)

FEATURE_COLLECTION = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "geometry",
                            T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))]),
                        ),
                        T.StructField("properties", FEATURE_PROPERTIES),
                    ]
                )
            ),
        )
    ]
)

#: "1" in rows of files whose dates begin with the day, "0" in others
DAY_FIRST_COLUMN = "DIA_PRIMERO"
