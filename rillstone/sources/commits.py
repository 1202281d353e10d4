"""Documents that are published once: written aside, then renamed to a name that must not exist yet."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Taken(Exception):
    """Another writer has published that name."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    return _fs(spark, name).exists(_path(spark, name))


def names(spark: SparkSession, folder: str) -> list[str]:
    """The sorted names in a folder; none where there is no folder."""
    fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, folder))) if exists(spark, folder) else []


def delete(spark: SparkSession, name: str) -> None:
    _fs(spark, name).delete(_path(spark, name), True)


def publish(spark: SparkSession, name: str, document: dict) -> None:
    """Write a JSON document under a name that nothing has; readers see all of it or nothing. Raises Taken."""
    fs, folder = _fs(spark, name), name.rpartition("/")[0]
    aside = _path(spark, f"{folder}/_aside-{uuid.uuid4().hex}")
    fs.mkdirs(_path(spark, folder))
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(document, ensure_ascii=False, indent=1).encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # never over a name that exists
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, _path(spark, name), options)
    except Py4JJavaError as failed:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" not in str(failed.java_exception.getClass()):
            raise
        raise Taken(name) from failed


def document(spark: SparkSession, name: str) -> dict:
    return json.loads(spark.read.text(name, wholetext=True).first()["value"])
