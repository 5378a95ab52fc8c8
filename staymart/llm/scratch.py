"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = "file://" + tempfile.mkdtemp(prefix="staymart-")
    return _LOCAL[application]


def keep(frame: DataFrame) -> DataFrame:
    """The rows of ``frame`` from a table written once, which cuts their lineage.

    A lost executor loses none of it, and no consumer computes it again. The table goes when
    the driver's file system closes.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/staymart-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(frame.schema).parquet(path)
