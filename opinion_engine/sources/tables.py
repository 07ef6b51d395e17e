"""Parquet tables that are replaced whole: a write that fails leaves the old table as it was.

Rows go to a new folder ``data-...``. Once it is complete, a manifest below ``_versions`` names the folders that make up
the table: this one small file is the switch. Readers take the last manifest. ``KEPT`` versions stay, so a frame that
was opened before goes on reading the old rows, also while they are being replaced. One writer at a time.

A part of a table is a folder of its own in the manifest, so a write can replace some parts and keep the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import files

KEPT = 2
WHOLE = ""


def new_folder(path: str) -> str:
    return f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return [name for name in files.children(spark, f"{path}/_versions") if not name.startswith(".")]


def parts(spark: SparkSession, path: str) -> dict[str, str]:
    """Folders by part of the current version; none where nothing was published."""
    found = _manifests(spark, path)
    return json.loads(files.read(spark, f"{path}/_versions/{found[-1]}")) if found else {}


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_manifests(spark, path))


def publish(spark: SparkSession, path: str, changed: Mapping[str, str], whole: bool = False) -> None:
    """Make ``changed`` parts current, and the only ones if they are the ``whole`` table; old versions go."""
    before = _manifests(spark, path)
    now = dict(changed) if whole else {**parts(spark, path), **changed}
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    files.create(spark, f"{path}/_versions/{number:012d}-{uuid.uuid4().hex}", json.dumps(now))
    kept = _manifests(spark, path)[-KEPT:]
    used = {_data(f) for name in kept for f in json.loads(files.read(spark, f"{path}/_versions/{name}")).values()}
    for name in before:
        if name not in kept:
            old = json.loads(files.read(spark, f"{path}/_versions/{name}"))
            for folder in {_data(f) for f in old.values()} - used:
                files.delete(spark, f"{path}/{folder}")
            files.delete(spark, f"{path}/_versions/{name}")


def _data(folder: str) -> str:
    return folder.split("/")[0]


def replace(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a table whose old rows stay until the new ones are complete."""
    folder = new_folder(path)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder)
    publish(df.sparkSession, path, {WHOLE: folder.rsplit("/", 1)[1]}, whole=True)


def current(spark: SparkSession, path: str) -> str:
    """The folder of a table's current version; a folder without versions is a table itself."""
    found = parts(spark, path)
    return f"{path}/{found[WHOLE]}" if WHOLE in found else path
