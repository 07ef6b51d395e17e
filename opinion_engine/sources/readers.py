"""Readers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from . import tables

# Quotes inside a field are doubled, in every CSV file that is read or written here.
CSV_QUOTING = {"header": "true", "quote": '"', "escape": '"'}
# An empty cell is null and a quoted empty cell is an empty text. By default both are null.
CSV_READING = {**CSV_QUOTING, "nullValue": "\u0000"}

# Files whose first lines one task reads.
HEADERS_PER_TASK = 64

TEXT_COLUMNS = ("review_body", "review")
USER_BUCKETS = 64


def _csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files behind a path; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return sorted(r["path"] for r in found.select("path").distinct().collect())


def _first_lines(spaces_count: bool) -> Callable:
    """The cells of each file's first line that is not blank; none for a file without one."""

    def run(batches: Iterator) -> Iterator:
        import csv
        import io

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
                with system.open_input_stream(name) as stream:
                    lines = csv.reader(io.TextIOWrapper(stream, "utf-8", errors="replace", newline=""))
                    found.append(next((row for row in lines if len(row) > 1 or (
                        row and (row[0] if spaces_count else row[0].strip()))), []))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["path", "header"])

    return run


def file_headers(
    spark: SparkSession, files: Sequence[str], multi_line: bool = True
) -> dict[tuple[str, ...], list[str]]:
    """Files by the cells of their first lines, from one pass that opens each file and reads no further.

    Paths are opened through pyarrow, packed files (``.gz``, ``.bz2``) as well. Files without a line are left out. As in
    Spark's reader, a line of spaces is blank unless lines may go on (``multi_line``).
    """
    paths = spark.createDataFrame([(f,) for f in files], "path string")
    tasks = max(2, -(-len(files) // HEADERS_PER_TASK))
    headers = paths.repartition(tasks).mapInArrow(_first_lines(multi_line), "path string, header array<string>")
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(tuple(r) for r in headers.collect()):  # one line per file
        if header:
            groups.setdefault(tuple(header), []).append(path)
    return groups


def column_names(header: Sequence[str]) -> list[str]:
    """Names for a header's cells: a cell without one, or with another's (in any case), gets its place added."""
    lower = [c.lower() for c in header]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(header)]


def read_reviews_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scan review files: names from each file's header, every column a string, nothing inferred.

    Files are read in groups of equal headers and joined by name, so their columns may come in any order; a
    column that a file lacks is null. One job lists the files and one looks at their first lines, however many
    files there are; ``infer_types`` finds the types of text columns.
    Quoted line breaks need ``multi_line``, which makes one task of each file. Files that
    hold no line breaks inside fields, such as an exported training set, can be read
    with ``multi_line=False`` and are then split.
    """
    return read_csv_files(spark, _csv_files(spark, path), multi_line)


def read_csv_files(
    spark: SparkSession, files: Sequence[str], multi_line: bool = True, file_column: str | None = None
) -> DataFrame:
    """The rows of CSV files by the names in their headers, with each row's file if ``file_column`` names it."""
    groups = file_headers(spark, files, multi_line) if files else {}
    if not groups:
        raise ValueError(f"no CSV file with a header among {list(files)}")
    # Each file's own header says what its columns are, so they are read by place.
    reader = spark.read.options(**CSV_READING, multiLine=multi_line, enforceSchema=True)
    parts = []
    for header, names in groups.items():
        columns = [T.StructField(c, T.StringType()) for c in column_names(header)]
        part = reader.schema(T.StructType(columns)).csv(names)
        parts.append(part.withColumn(file_column, F.col("_metadata.file_path")) if file_column else part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def with_row_id(df: DataFrame, name: str = "review_id") -> DataFrame:
    """Number the rows of a file scan that brings no id.

    Unique, and repeatable for the same files and split size. Write the stage to keep it.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def with_id(df: DataFrame, name: str = "review_id") -> DataFrame:
    """The rows' own numbers where the files bring them, else numbers of ``with_row_id``."""
    return df.withColumn(name, F.col(name).try_cast("bigint")) if name in df.columns else with_row_id(df, name)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stored stage."""
    return spark.read.parquet(tables.current(spark, path))


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """A training set as written by ``export_csv``, by the names in its header; its texts hold no line breaks."""
    named = read_reviews_csv(spark, path, multi_line=False)
    return named.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.TRAINING])


def read_scored_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Scored reviews with typed columns. Texts such as ``null`` or ``nan`` stay texts."""
    return typed(read_reviews_csv(spark, path, multi_line), types)


def typed(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Text columns cast to the types that their names have by contract; what does not parse is null."""
    wanted = schema.SCORED_TYPES if types is None else types
    return df.withColumns({c: F.col(f"`{c}`").try_cast(wanted[c]) for c in df.columns if c in wanted})


# Texts that a number, a truth value, a day or a time may be written as. A number has no leading zeros.
_BOOLEAN = r"(?i)^(true|false)$"
_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_NUMBER = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
#: Types with the texts they take; a whole number is a number, and all else meets only in ``string``.
_LATTICE = {"boolean": _BOOLEAN, "bigint": _WHOLE, "double": _NUMBER, "date": _DAY, "timestamp": _TIME}


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type that all texts of each column have, ``string`` if there is none or no text at all.

    One aggregate over the whole table counts the texts that each type does not take; counts of parts add up, so
    the layout does not matter. A text such as ``007`` or ``+49`` is no number: codes stay texts.
    """
    names = [c for c in (columns or df.columns) if dict(df.dtypes)[c] == "string"]
    if not names:
        return {}
    counts = []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        counts.append(F.count(value).alias(f"{i}"))
        for kind, pattern in _LATTICE.items():
            fits = value.rlike(pattern) & value.try_cast(kind).isNotNull()
            counts.append(F.count_if(value.isNotNull() & ~fits).alias(f"{i}_{kind}"))
    found = df.agg(*counts).first()
    return {name: next((k for k in _LATTICE if found[f"{i}"] and not found[f"{i}_{k}"]), "string")
            for i, name in enumerate(names)}


def read_inferred_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV files by their headers, with the types that their texts have; read twice."""
    rows = read_reviews_csv(spark, path, multi_line)
    return typed(rows, infer_types(rows))


def read_metrics_json(spark: SparkSession, path: str, document: T.StructType) -> DataFrame:
    """One metrics document, compact or indented."""
    return spark.read.schema(document).option("multiLine", True).json(path)


def resolve_text_column(df: DataFrame) -> str:
    """The name of the review text column, or an error before anything runs."""
    for name in TEXT_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"no review column: expected one of {TEXT_COLUMNS}, found {df.columns}")


def read_partitioned(spark: SparkSession, path: str, text_partitions: Sequence[str]) -> DataFrame:
    """A table with folder columns that are texts, also where they look like numbers (``007``)."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in text_partitions else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_user_partition(spark: SparkSession, path: str, user: str, column: str = "user_name") -> DataFrame:
    """The rows of one user; only that user's folder is read."""
    return read_partitioned(spark, path, [column]).filter(F.col(column) == user)


def user_bucket(user: Column, buckets: int = USER_BUCKETS) -> Column:
    """The bucket of ``write_by_user`` that holds a user's rows; -1 without a user."""
    return F.when(user.isNotNull(), F.pmod(F.xxhash64(user), F.lit(buckets))).otherwise(-1).cast("int")


def read_by_user(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """All rows of a table of ``write_by_user``."""
    folders = [f"{path}/{f}" for f in tables.parts(spark, path).values()]
    return spark.read.schema(row_schema).parquet(*folders) if folders else spark.createDataFrame([], row_schema)


def read_one_user(
    spark: SparkSession, path: str, user: str, row_schema: T.StructType, column: str = "user_name",
    buckets: int = USER_BUCKETS,
) -> DataFrame:
    """The rows of one user: one bucket, and of its files the row groups that may hold the user."""
    number = spark.range(1).select(user_bucket(F.lit(user), buckets)).first()[0]
    folder = tables.parts(spark, path).get(str(number))
    rows = spark.read.schema(row_schema).parquet(f"{path}/{folder}") if folder else spark.createDataFrame([], row_schema)
    return rows.filter(F.col(column) == user)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an ordered export with ``part`` (a file's number) and ``place``, which ascends within a part.

    Each file is read by one task, whose rows keep their order. Store the rows before their places are used twice.
    """
    rows = read_csv_files(spark, _csv_files(spark, path), file_column="part")
    number = F.regexp_extract("part", r"part-([0-9]+)[^/]*$", 1).cast("long")
    return rows.withColumns({"part": number, "place": F.monotonically_increasing_id()})
