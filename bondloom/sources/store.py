"""Writers of stored tables: folders of Parquet by month, written anew where they are touched.

Plain Parquet has no merge, so a month is read, changed and written as a whole. It is staged
first, because it is read and written in one step; a step that runs again writes the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bondloom.sources.state import keep_or_replace

#: Columns of a file's record that may be set.
FILE_COLUMNS = ("sha256", "file_type", "report_date", "posted_date", "downloaded_at", "parse_status", "parse_note")


def month_of(day: str) -> Column:
    return F.date_format(F.trunc(day, "month"), "yyyy-MM")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there. What cannot be looked up raises: it is never taken for absent."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def rewrite_months(new: DataFrame, path: str, staging: str, change: Callable[[DataFrame | None, DataFrame], DataFrame], day: str = "obs_date") -> None:
    """Writes ``change(old, new)`` over the months that ``new`` touches; old is None if nothing
    is stored yet. A failed read raises before anything is written."""
    spark = new.sparkSession
    rows = new.withColumn("month", month_of(day)).persist()
    try:
        months = [r[0] for r in rows.select("month").distinct().collect()]  # few: one name a month
        old = spark.read.parquet(path).where(F.col("month").isin(months)).withColumn("month", F.col("month").cast("string")) if exists(spark, path) else None
        change(old, rows).write.mode("overwrite").parquet(staging)
        staged = spark.read.parquet(staging)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    finally:
        rows.unpersist()


def replace_days(new: DataFrame, path: str, staging: str, day: str = "obs_date") -> None:
    """Deletes the stored rows of the days of ``new`` and inserts its own. Other days stay, so
    a day that could not be fitted keeps the fit it had."""

    def change(old: DataFrame | None, rows: DataFrame) -> DataFrame:
        if old is None:
            return rows
        return old.join(rows.select(day).distinct(), day, "left_anti").unionByName(rows, allowMissingColumns=True)

    rewrite_months(new, path, staging, change, day)


def rebuild(df: DataFrame, path: str) -> None:
    """Writes a whole derived table anew. It is complete beside the old one before that goes."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(fresh)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"could not put {fresh} in the place of {path}")


def store_stats(stats: DataFrame, path: str) -> None:
    """(key, value, n) into the stored statistics with the time they were measured. A statistic
    that is not measured any more keeps its last value. A handful of rows."""
    spark = stats.sparkSession
    new = stats.select("key", F.col("value").cast("double"), F.col("n").cast("long"), F.current_timestamp().alias("measured_at"))
    rebuild(keep_or_replace(new, spark.read.parquet(path), "key") if exists(spark, path) else new, path)


def file_changes(files: DataFrame, **fields: Column) -> DataFrame:
    """A partial update of file records: url and the given fields; others stay as they are when
    the arrivals are reduced by ``last_known``. Unknown fields are refused."""
    unknown = set(fields) - set(FILE_COLUMNS)
    if unknown:
        raise ValueError(f"unknown columns of a file: {sorted(unknown)}")
    return files.select("url", *[value.alias(name) for name, value in fields.items()])


def migrated(stored: DataFrame, schema: StructType | str, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """``stored`` with all columns of ``schema``: ones added since are null, further ones stay."""
    spark = stored.sparkSession
    for old, new in (renamed or {}).items():
        stored = stored.withColumnRenamed(old, new)
    wanted = spark.createDataFrame([], schema)
    return wanted.unionByName(stored, allowMissingColumns=True)
