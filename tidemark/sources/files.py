"""Small files and whole folders on any Hadoop file system, from the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    place, system = _path(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside `path` and rename it over it, so readers see the old text or the new one."""
    jvm = spark.sparkContext._jvm
    new, system = _path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(new, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    place = jvm.org.apache.hadoop.fs.Path(path)
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new, place, overwrite)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Move a finished folder to `path`; what was there is moved aside first and deleted last."""
    source, system = _path(spark, new)
    target, aside = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}"))
    system.mkdirs(target.getParent())
    held = system.exists(target)
    if held and not system.rename(target, aside):
        raise OSError(f"{path} could not be moved aside")
    if not system.rename(source, target):
        raise OSError(f"{new} could not be moved to {path}")
    if held:
        system.delete(aside, True)
