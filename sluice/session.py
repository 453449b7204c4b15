"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings decoding depends on: of two members with one name the last counts, and
# days are cut in UTC.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Of files that are written to be read again: half the bytes of the default.
COMPRESSION = "zstd"


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def require_settings(spark: SparkSession) -> None:
    """Fail where decoding would give other results than with :func:`prepare`."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            raise ValueError(f"{name} must be {value}: call prepare(spark) first")


def shared_folder(spark: SparkSession) -> str:
    """The folder all nodes can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session that runs in this one process gets a folder of its own if it is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all nodes")
    folder = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; not created."""
    return f"{shared_folder(spark)}/sluice/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`new_folder` named and nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    For decoded events that a plan uses more than once: they are decoded a single time, and
    a lost executor costs no second decoding.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
