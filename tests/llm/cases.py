"""Small documents with every edge value, and plain versions of the operators to compare with."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import DataFrame, SparkSession

#: Extra columns with the names of operators' own columns.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, fp long, score double, "
          "lines int, spans string, n_words long, kept string, row int, hashes binary, word long, rejected int")
_EXTRA = (1, 2, 0.5, 3, "spans", 7, "kept", 4, b"h", 5, 6)


def documents(spark: SparkSession, rows: list[tuple], schema: str = SCHEMA) -> DataFrame:
    """A frame of (doc_id, text) or (doc_id, text, lang) rows in three partitions."""
    full = [(i, t, *(rest or ["en"]), "src", len(t or ""), *_EXTRA) for i, t, *rest in rows]
    return spark.createDataFrame(full, schema).repartition(3)


def words(n: int, seed: int) -> list[str]:
    chosen = random.Random(seed)
    return ["".join(chosen.choice("abcdefghij") for _ in range(chosen.randint(1, 7))) for _ in range(n)]


def edge_rows() -> list[tuple]:
    """Null and empty texts, null and repeated ids, repeated rows, ties, a very long text and odd characters."""
    passage, other = " ".join(words(40, 1)), " ".join(words(60, 2))
    line = "\n".join([" ".join(words(6, k)) for k in range(10, 15)])
    return [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, passage), (5, passage), (6, "x " + passage + " y"), (7, other),
        (7, passage + " tail"), (8, passage + " " + passage), (None, passage), (None, None), (9, line),
        (10, "start\n" + line + "\nend"), (10, "start\n" + line + "\nend"), (11, " ".join(words(30_000, 3))),
        (12, "Ünï côdé text \U0001f600 \u0000 " + passage.upper()), (13, "a\n\n\n\n\n\nb\n\n\n\n\n"), (14, "z" * 20_000),
        (-5, other), (15, " ".join(["same"] * 50)), (16, "one"),
    ]


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def order_of(doc_id: int | None) -> int:
    return (1 << 63) - 1 if doc_id is None else doc_id


def later_starts(windows: dict[int, list[tuple[int, object]]]) -> list[set[int]]:
    """For rows in order: the starts of windows with an occurrence at a smaller (id, start). Rows: (id, windows)."""
    first: dict[object, tuple[int, int]] = {}
    for key, found in windows:
        for start, window in found:
            first[window] = min(first.get(window, (key, start)), (key, start))
    return [{s for s, w in found if first[w] < (key, s)} for key, found in windows]
