"""Files and folders on any store that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names below a folder in order; none if there is no such folder."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(place))


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet; it appears whole or not at all."""
    store, place = _at(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{place.getParent()}/.{place.getName()}.part")
    stream = store.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if store.exists(place) or not store.rename(part, place):
        store.delete(part, False)
        raise FileExistsError(path)


def read(spark: SparkSession, path: str) -> str:
    store, place = _at(spark, path)
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)
