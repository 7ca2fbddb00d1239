"""The filtered report: trend, heatmap, two top lists, hierarchy, map."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.functions.dates import safe_date, safe_timestamp, weekday_es
from almenara.operators import aggregates as A
from almenara.operators.filters import ReportFilter
from almenara.operators.joins import map_has_points, map_points
from almenara.operators.standardize import require_columns
from almenara.plans.tables import folder_of
from almenara.schema import TIMESTAMP_COLUMN
from almenara.sources.geojson import read_localities
from almenara.sources.tables import read_parquet

#: columns the report queries read
REPORT_COLUMNS = [
    "FECHA", "HORA", "DIA_SEMANA", "LOCALIDAD", "TIPO_INCIDENTE", "PRIORIDAD_FINAL", "CODIGO_LOCALIDAD",
]


def prepare_incidents(df: DataFrame, ts_col: str = TIMESTAMP_COLUMN) -> DataFrame:
    """Add or refresh ``FECHA, TS_SAFE, HORA, DOW, DIA_SEMANA``.

    A column that already has its type is used as it is; rendering a timestamp
    as text to parse it again would only cost time, and casting a date to a
    date would hide it from the scan's filters.
    """
    require_columns(df, ["FECHA", ts_col])
    types = dict(df.dtypes)
    typed = types[ts_col] in ("timestamp", "timestamp_ntz")
    dated = df if types["FECHA"] == "date" else df.withColumn("FECHA", safe_date("FECHA"))
    stamp = F.col(ts_col) if typed else safe_timestamp(ts_col)
    return dated.withColumn("TS_SAFE", stamp).withColumns(
        {
            "HORA": F.hour("TS_SAFE"),
            "DOW": F.dayofweek("FECHA"),
            "DIA_SEMANA": weekday_es("FECHA"),
        }
    )


def incident_cube(df: DataFrame) -> DataFrame:
    """Counts per combination of all report columns: every report query, and
    every report filter, gives on it what it gives on the rows."""
    return A.totals(df, *[c for c in REPORT_COLUMNS if c in df.columns])


def _heatmap_matrix(kept, localities, weight, top):
    return A.weekday_hour_matrix(A.weekday_hour_totals(kept, weight, keep_nulls=False))


def _hierarchy_totals(kept, localities, weight, top):
    return A.hierarchy_totals(A.priority_type_totals(kept, weight, keep_nulls=False))


#: report table -> how to make it from the filtered incidents
REPORT_PARTS: dict[str, Callable[[DataFrame, DataFrame, str | None, int], DataFrame]] = {
    "trend": lambda kept, loc, weight, top: A.daily_trend(kept, weight),
    "heatmap": lambda kept, loc, weight, top: A.weekday_hour_totals(kept, weight, keep_nulls=False),
    "heatmap_matrix": _heatmap_matrix,
    "top_localities": lambda kept, loc, weight, top: A.top_totals(kept, "LOCALIDAD", top, weight),
    "top_types": lambda kept, loc, weight, top: A.top_totals(kept, "TIPO_INCIDENTE", top, weight),
    "hierarchy": lambda kept, loc, weight, top: A.priority_type_totals(kept, weight, keep_nulls=False),
    "hierarchy_totals": _hierarchy_totals,
    "map": lambda kept, loc, weight, top: map_points(kept, loc, weight=weight),
    "map_has_points": lambda kept, loc, weight, top: map_has_points(map_points(kept, loc, weight=weight)),
}


def report(
    incidents: DataFrame,
    localities: DataFrame,
    request: ReportFilter = ReportFilter(),
    weight: str | None = None,
    top: int = 10,
    parts: Iterable[str] = tuple(REPORT_PARTS),
) -> dict[str, DataFrame]:
    """The report tables for one request, each a lazy frame.

    On prepared incident rows each table is one scan of its own columns with
    the filter pushed down. For many requests over the same data pass a
    persisted ``incident_cube`` with ``weight="TOTAL"``.
    """
    kept = request.apply(incidents)
    return {name: REPORT_PARTS[name](kept, localities, weight, top) for name in parts}


class ReportSession:
    """Report over a stored incident table, for many requests.

    Keeps the cube, not the rows, in memory (spilling to disk). It is counted
    from the table again should an executor be lost.
    """

    def __init__(self, incidents: DataFrame, localities: DataFrame):
        self.localities = localities
        self.cube = incident_cube(incidents).persist(StorageLevel.MEMORY_AND_DISK)

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        config: Mapping[str, str],
        filename: str = "localidades_xy.geojson",
        general_folder: str = "incidentes",
    ) -> ReportSession:
        stored = read_parquet(spark, f"{folder_of(config, 'data_procesada')}/{general_folder}")
        incidents = prepare_incidents(stored, config.get("ts_col", TIMESTAMP_COLUMN))
        points = read_localities(spark, f"{folder_of(config, 'data_complementaria')}/{filename}")
        return cls(incidents, points)

    def materialize(self) -> int:
        """Fill the cache now; returns the number of incidents."""
        return self.cube.agg(A.row_count("TOTAL")).first()[0] or 0

    def bounds(self) -> DataFrame:
        return A.date_bounds(self.cube)

    def localities_domain(self) -> DataFrame:
        return A.domain(self.cube, "LOCALIDAD")

    def types_domain(self) -> DataFrame:
        return A.domain(self.cube, "TIPO_INCIDENTE")

    def request(self, request: ReportFilter = ReportFilter()) -> dict[str, DataFrame] | None:
        """The report tables, or None if the filter leaves no incidents."""
        if request.apply(self.cube).isEmpty():
            return None
        return report(self.cube, self.localities, request, weight="TOTAL")

    def close(self) -> None:
        self.cube.unpersist()

    def __enter__(self) -> ReportSession:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
