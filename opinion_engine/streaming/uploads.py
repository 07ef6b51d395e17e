"""Clean and score upload files as they arrive.

The stream carries the paths of new files. Each batch reads its files by their own headers and runs the batch
operators on the rows. No watermark is needed: nothing depends on event time. The per-user summary is keyed state
(``streaming.summary``) that takes up one small row per user and batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators import serving
from ..plans.uploads import clean_upload
from ..sources import readers

USER = "user_name"

_FILES = "path string, modificationTime timestamp, length long, content binary"
_SCHEME = "^[a-zA-Z0-9]+:/*"


def upload_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New CSV files below a folder, as paths; ``files_per_batch`` bounds what one batch lists."""
    return (spark.readStream.format("binaryFile").schema(_FILES)
            .option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv").load(folder)
            .select("path", F.lit(folder).alias("root")))


def _decoded(path: F.Column) -> F.Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def read_uploads(spark: SparkSession, files: list[str], root: str) -> DataFrame:
    """The rows of upload files by header name, with the file's name and the time written in it.

    Without a user column, or where it is null, the user is the folder that a file below ``root`` lies in.
    ``upload_id`` is made from the path and the place in the file where the files bring none.
    """
    rows = readers.typed(readers.read_csv_files(spark, files, file_column="file_path"))
    path = _decoded(F.regexp_replace("file_path", _SCHEME, "/"))
    name, parent = F.substring_index(path, "/", -1), F.regexp_replace(path, "/[^/]*$", "")
    top = F.regexp_replace(F.lit(root.rstrip("/")), _SCHEME, "/")
    folder = F.when(parent != top, F.regexp_replace(F.substring_index(parent, "/", -1), f"^{USER}=", ""))
    user = F.coalesce(F.col(USER), folder) if USER in rows.columns else folder
    out = rows.withColumns({"file_name": name, USER: user, "uploaded_at": text.upload_time(name)})
    if "upload_id" not in rows.columns:
        place = F.monotonically_increasing_id()
        out = out.withColumn("upload_id", F.format_string("%s#%019d", path, place))
    return out.drop("file_path")


def _query_id(spark: SparkSession) -> str:
    """The running stream's id, which is kept in its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _each_batch(uploads: DataFrame, checkpoint: str, run: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Run a function on the rows of each batch and the batch's folder name.

    The name holds the stream's id, so a stream that is started anew with another checkpoint leaves the folders
    of the old one alone, and a batch that is run again replaces its own.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = batch.collect()  # at most files_per_batch paths
        if found:
            rows = read_uploads(spark, [r["path"] for r in found], found[0]["root"])
            run(rows, f"stream={_query_id(spark)}/batch={number}")

    return (uploads.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def clean_uploads(uploads: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Add the cleaned rows to a table with folders per stream, batch and user."""

    def clean(rows: DataFrame, folder: str) -> None:
        clean_upload(rows).write.mode("overwrite").partitionBy(USER).parquet(f"{out}/{folder}")

    return _each_batch(uploads, checkpoint, clean)


def score_uploads(
    uploads: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Clean and score each batch, and store its share of the per-user summary, one row per user.

    A batch's work depends on its own rows. ``summary.update`` takes the shares up.
    """

    def one_batch(rows: DataFrame, folder: str) -> None:
        spark = rows.sparkSession
        score(clean_upload(rows)).write.mode("overwrite").parquet(f"{out}/scored/{folder}")
        scored = spark.read.parquet(f"{out}/scored/{folder}")
        share = serving.summary_share(scored, USER).withColumn("source", F.lit(folder))
        share.write.mode("overwrite").parquet(f"{out}/shares/{folder}")

    return _each_batch(uploads, checkpoint, one_batch)
