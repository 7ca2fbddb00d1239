"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name: str = "almenara", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI and adaptive execution on.

    ``master`` is left to spark-submit unless given. Keyword settings use
    double underscores for dots (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, below ``spark.checkpoint.dir``.

    On a cluster that setting names a folder every executor sees, and it has to
    be set. With a local master a temporary folder will do instead.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "")
    if not shared and not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="almenara-")
    return f"{base}/{purpose}-{uuid.uuid4().hex}"
