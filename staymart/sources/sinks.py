"""Date-stamped output."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def run_path(base: str, run_date: date | str, prefix: str = "daily_extract") -> str:
    return f"{base.rstrip('/')}/{prefix}_{run_date}"


def write_extract(
    extract: DataFrame,
    base: str,
    run_date: date | str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> str:
    """Write one run to its own dated folder and return the path.

    ``errorifexists`` refuses a second run for a date, ``overwrite`` makes the run
    repeatable. Any installed format works; Avro needs its package on the classpath.
    """
    path = run_path(base, run_date)
    writer = extract.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def read_extract(
    spark: SparkSession, base: str, run_date: date | str, fmt: str = "parquet"
) -> DataFrame:
    return spark.read.format(fmt).load(run_path(base, run_date))


def merge_extract(changed: DataFrame, path: str, keys: Sequence[str], part: str) -> None:
    """Put changed rows in the place of those with their keys in the extract at ``path``.

    The extract is parted by ``part``, a column that never changes for a key, such as the
    period in which a booking was created. Only parts with changes are read and written anew,
    each replaced as a whole, so a second run with the same rows changes nothing. The rows are
    written beside the extract first, as one plan feeds both the list of parts and the merge.
    """
    spark = changed.sparkSession
    names = changed.columns
    staged = f"{shared_folder(spark)}/changed"
    changed.write.parquet(staged)
    new = spark.read.schema(changed.schema).parquet(staged)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    merged = new
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        old = spark.read.schema(changed.schema).parquet(path).select(*names)
        touched = old.join(new.select(part).distinct(), part, "left_semi")
        same = [touched[key].eqNullSafe(new[key]) for key in keys]
        merged = touched.join(new, same, "left_anti").select(*names).unionByName(new)
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(part).parquet(path)


def write_once(rows: DataFrame) -> DataFrame:
    """``rows`` from a table of their own, which has a known size and is worked out once."""
    folder = f"{shared_folder(rows.sparkSession)}/rows"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, removed when the driver's file system closes.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="staymart-")
    folder = f"{base.rstrip('/')}/staymart-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return folder
