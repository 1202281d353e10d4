"""Tables that a step writes in the folder all executors share, and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; in local mode, where it is unset, one temporary folder for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        name = spark.sparkContext.applicationId
        folder = _LOCAL.setdefault(name, "") or "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        _LOCAL[name] = folder
    return folder.rstrip("/")


def shared_path(spark: SparkSession) -> str:
    """A new path in that folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a written table: its rows, and values such as partition numbers, are the same in every later use."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
