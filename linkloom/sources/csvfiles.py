"""CSV exports.  Each export is a folder of part files, written in parallel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_AS_IT_IS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def log_export(log: DataFrame, base: str, run_ts: dt.datetime) -> str:
    """Write the log as headerless CSV to ``access_log_<stamp>.csv`` and return its path."""
    path = f"{base}/access_log_{run_ts:%Y%m%d-%H%M%S}.csv"
    log.write.option("header", False).option("escape", '"').csv(path)
    return path


def csv_saving(rows: DataFrame, path: str) -> None:
    """Write records as CSV with a header line in every part file and no index.

    Blanks at the ends of values are kept, and line ends inside them are quoted; :func:`csv_reading`
    gives the same rows back.
    """
    rows.write.options(**_AS_IT_IS).csv(path)


def csv_reading(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of files with header lines; values may hold line ends."""
    return spark.read.schema(schema).options(**_AS_IT_IS, multiLine=True).csv(path)
