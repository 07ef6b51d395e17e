"""Review-shaped views of the given tables.

The expressions are plain SQL that Spark and DuckDB read alike. ``review_id`` and
``upload_id`` are the document's id; every row of the table is used with its whole text. A few
edge rows with negative ids are added to reviews and uploads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RATING_TEXT = """case doc_id % 13 when 0 then null when 1 then 'abc' when 2 then '-1' when 3 then '0.5'
    when 4 then '7' when 5 then '3.7' when 6 then '3' when 7 then '1' when 8 then '2'
    when 9 then 'NaN' else cast(doc_id % 5 + 1 as string) end"""

HEADLINE = "split_part(text, chr(10), 1)"

USER_NAME = "'user' || cast(doc_id % 7 as string)"

REVIEWS = {
    "review_id": "doc_id",
    "product_category": "source",
    "star_rating": RATING_TEXT,
    "review_body": "text",
    "review_headline": HEADLINE,
}

UPLOADS = {"upload_id": "doc_id", "user_name": USER_NAME, "review": "text"}

# Rows that the given texts lack: (id, category, rating, body, headline) and (id, user, text).
REVIEW_EDGES = """(-1, 'edge', '5', '', 'empty'), (-2, 'edge', '1', null, 'missing'), (-3, 'edge', '4', '   ', 'blank'),
    (-4, 'edge', '2', 'no headline', null), (-5, null, '5', 'A  Copy', 'one'), (-6, 'edge', '1', ' a copy ', 'two'),
    (-7, 'edge', null, null, null), (-8, 'edge', '5', 'Größe und Überblick', 'other letters')"""
UPLOAD_EDGES = """(-1, 'user0', '12345 678'), (-2, 'user1', '   '), (-3, 'user2', null), (-4, 'user3', '  Short and  GOOD '),
    (-5, null, 'Nobody left this review, which is long enough'), (-6, null, 'bad'), (-7, 'user4', ''),
    (-8, 'user5', 'Привет, schön gut für alle')"""

# Names of upload files; every fifth has no time or an impossible one.
FILE_NAME = """case doc_id % 5 when 0 then 'reviews.csv' when 1 then '20241331000000_x.csv' else
    '20240' || cast(doc_id % 9 + 1 as string) || '1' || cast(doc_id % 10 as string) || '1' || cast(doc_id % 10 as string)
    || '2' || cast(doc_id % 8 as string) || '3' || cast(doc_id % 7 as string) || '_reviews.csv' end"""

# Columns of many kinds, as texts. An order's key is written with and without leading zeros, and in one place a word.
MIXED = {
    "code": "lpad(cast(o_orderkey as string), 12, '0')",
    "number": "cast(o_orderkey as string)",
    "mostly_number": "case when o_orderkey % 100 = 3 then 'none' else cast(o_custkey as string) end",
    "sparse_number": "case when o_orderkey % 3 = 0 then cast(o_custkey - 500 as string) end",
    "amount": "case when o_orderkey % 2 = 0 then cast(o_custkey as string) else cast(o_custkey as string) || '.25' end",
    "open_order": "case when o_orderkey % 2 = 0 then 'true' else 'FALSE' end",
    "ordered": "substr(cast(o_orderdate as string), 1, 10)",
    "ordered_at": "substr(cast(o_orderdate as string), 1, 10) || ' 12:30:00'",
    "ordered_or_not": "case when o_orderkey % 2 = 0 then substr(cast(o_orderdate as string), 1, 10) else '2024-02-30' end",
    "nothing": "cast(null as string)",
    "status": "o_orderstatus",
}

TURNS = {"conv_id": "conv_id", "turn": "turn", "user_name": "role", "review": "text"}

_HASH = "md5(cast(doc_id as string))"
_SPREAD = (f"(ascii(substr({_HASH}, 1, 1)) * 31 + ascii(substr({_HASH}, 2, 1)) * 7"
           f" + ascii(substr({_HASH}, 3, 1)))")
_POSITIVE = f"(cast(quality * 40 + {_SPREAD} % 60 as double) / 100 + cast(0.005 as double))"

SCORED = {
    "doc_id": "doc_id",
    "label": "quality",
    "positive_score": _POSITIVE,
    "negative_score": f"1 - {_POSITIVE}",
    "prediction": f"case when {_POSITIVE} > 0.5 then 1 else 0 end",
}


def select_sql(columns: dict[str, str], table: str) -> str:
    listed = ", ".join(f"{sql} as {name}" for name, sql in columns.items())
    return f"select {listed} from {table}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(columns: dict[str, str], df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"{sql} as {name}" for name, sql in columns.items()])


def _edges(columns: dict[str, str], rows: str) -> str:
    """SQL of literal rows under the view's names."""
    names = list(columns)
    typed = ", ".join([f"cast({names[0]} as bigint) as {names[0]}", *[f"cast({c} as string) as {c}" for c in names[1:]]])
    return f"select {typed} from (values {rows}) as e({', '.join(names)})"


def reviews_sql() -> str:
    return f"{select_sql(REVIEWS, 'documents')} union all {_edges(REVIEWS, REVIEW_EDGES)}"


def uploads_sql() -> str:
    return f"{select_sql(UPLOADS, 'documents')} union all {_edges(UPLOADS, UPLOAD_EDGES)}"


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return view(REVIEWS, table(spark, folder, "documents")).unionByName(spark.sql(_edges(REVIEWS, REVIEW_EDGES)))


def uploads(spark: SparkSession, folder: str) -> DataFrame:
    return view(UPLOADS, table(spark, folder, "documents")).unionByName(spark.sql(_edges(UPLOADS, UPLOAD_EDGES)))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of every conversation as an uploaded text, by role."""
    return view(TURNS, table(spark, folder, "conversations"))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return view(SCORED, table(spark, folder, "labels"))


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have a label; the label rides along with the text afterwards."""
    labels = table(spark, folder, "labels").selectExpr("doc_id", "quality as label")
    return table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")
