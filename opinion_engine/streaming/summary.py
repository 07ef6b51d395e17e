"""The per-user summary of scored uploads as keyed state.

Each batch of ``score_uploads`` leaves a share: one row per user with counts and first reviews, made by the batch's
aggregates, so a user with a third of all rows is one row here. A stream over the shares keeps, per user, the running
totals in a state store. A share that was taken up is deleted from its folder by the stream's source, so neither folders
nor work grow with the number of batches. A share is counted once: the state knows the last batch of each
stream, and batches of a stream come in order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming import StreamingQuery

from ..operators import serving

USER = "user_name"
_COUNTS = serving.COUNTS
_TOP = "array<struct<upload_id:string,text:string>>"
SHARE = ", ".join([f"{USER} string", *[f"{c} long" for c in _COUNTS], f"tops_positive {_TOP}", f"tops_negative {_TOP}",
                   "source string"])
_STATE = ", ".join([*[f"{c} long" for c in _COUNTS], f"tops_positive {_TOP}", f"tops_negative {_TOP}",
                    "seen map<string,long>"])
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class UserTotals(StatefulProcessor):
    """Adds shares to a user's totals."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        shares = sorted((_place(r["source"]) + (r,) for frame in rows for r in frame.to_dict("records")), key=lambda x: x[:2])
        old = self.totals.get() if self.totals.exists() else None
        counts = list(old[:len(_COUNTS)]) if old else [0] * len(_COUNTS)
        tops = [[tuple(t) for t in old[len(_COUNTS) + k]] if old else [] for k in range(2)]
        seen = dict(old[-1]) if old else {}
        for stream, batch, share in shares:
            if batch <= seen.get(stream, -1):
                continue
            seen[stream] = batch
            counts = [a + int(share[c]) for a, c in zip(counts, _COUNTS)]
            for k, name in enumerate(serving.NAMES):
                new = [(t["upload_id"], t["text"]) for t in share[f"tops_{name}"]]
                tops[k] = sorted(set(tops[k]) | set(new), key=lambda t: serving.id_order(t[0]))[:serving.TOP]
        self.totals.update((*counts, *tops, seen))
        yield pd.DataFrame({"user_name": [key[0]], "total_reviews": [counts[0]]})

    def close(self) -> None:
        pass


def _place(source: str) -> tuple[str, int]:
    """The stream and the number of a batch's folder."""
    stream, batch = (part.split("=")[1] for part in source.split("/"))
    return stream, int(batch)


def update(spark: SparkSession, out: str) -> StreamingQuery:
    """Take up the shares that are there now."""
    shares = (spark.readStream.schema(SHARE).option("recursiveFileLookup", "true").option("cleanSource", "delete")
              .option("latestFirst", "false").parquet(f"{out}/shares"))
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        totals = shares.groupBy(USER).transformWithStateInPandas(
            UserTotals(), "user_name string, total_reviews long", "Update", "None")
        return (totals.writeStream.format("noop").outputMode("update")
                .option("checkpointLocation", f"{out}/summary").trigger(availableNow=True).start())
    finally:
        spark.conf.set(_STORE, before)


def read(spark: SparkSession, out: str) -> DataFrame:
    """The summary of all shares taken up, from the state itself."""
    state = spark.read.format("statestore").option("stateVarName", "totals").load(f"{out}/summary").select(
        F.col(f"key.{USER}").alias(USER), "value.*")
    return serving.summary_of_share(state, USER)
