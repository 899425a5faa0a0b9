"""URLs deduplicated by keyed state: the first row of a key on its day at once, late rows beside, none lost.

A day's keys are kept in map states on the RocksDB store, a day in `BUCKETS` parts, so a hot day is held by
many tasks. When the watermark passes a day by the allowed delay, a timer clears its state: what is
held is bounded by the open days. Rows that come later are not compared but marked `late`; `settled` lets
them in if nothing of their key was there before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from presslake.operators.dedup import dedupe_by
from presslake.streaming.ingest import run_name

BUCKETS = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MS_PER_DAY = 86_400_000
FIRST, LATE = "first", "late"


class FirstOfDay(StatefulProcessor):
    """For a group (day number, bucket): rows whose `state_key` was not seen yet, or all of them once the day is closed."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "key string", "batch_row int")

    def closes(self, key: tuple) -> int:
        return (int(key[0]) + 1) * MS_PER_DAY + self.delay_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        late = timerValues.getCurrentWatermarkInMs() >= self.closes(key)
        if not late and not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(self.closes(key))
        for chunk in rows:
            if not len(chunk):
                continue
            chunk = chunk.drop_duplicates("state_key")
            if not late:
                new = [not self.seen.containsKey((k,)) for k in chunk["state_key"]]
                chunk = chunk[new]
                for k in chunk["state_key"]:
                    self.seen.updateValue((k,), (1,))
            if len(chunk):
                yield chunk.drop(columns=["state_day", "state_bucket", "state_key"]).assign(kind=LATE if late else FIRST)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_per_day(df: DataFrame, keys: Sequence[str], ts: str = "ts", delay: timedelta = timedelta(days=1)) -> DataFrame:
    """Rows of the stream whose `keys` are new on the day of `ts`, with `kind`: `first`, or `late` if the day's state
    is gone (its end is more than `delay` before the latest time seen). A null time counts as the day 1970-01-01. Column names
    must be plain (the state interface renames those that begin with an underscore)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    days = F.coalesce(F.unix_date(F.col(ts).cast("date")), F.lit(0))
    # The watermark follows `_clock`, which ends here: the operator after it still gets late rows.
    clocked = df.withColumn("_clock", F.col(ts).cast("timestamp")).withWatermark("_clock", "0 seconds").drop("_clock")
    grouped = clocked.withColumns({"state_day": days, "state_bucket": F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int"), "state_key": text})
    out = T.StructType([*df.schema.fields, T.StructField("kind", T.StringType())])
    return grouped.groupBy("state_day", "state_bucket").transformWithStateInPandas(FirstOfDay(delay // timedelta(milliseconds=1)), out, "append", "EventTime")


def write_kinds(rows: DataFrame, path: str) -> DataStreamWriter:
    """Each batch of `first_per_day` under its run and number, `first` and `late` rows apart; a replayed batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/run={run_name(batch)}/batch_id={batch_id}")

    return rows.writeStream.outputMode("append").foreachBatch(write)


def settled(spark: SparkSession, path: str, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Each key once per day: the first row, or where there is none a late one. Runs that read the same files add nothing."""
    rows = spark.read.parquet(path).withColumn("_settled_day", F.col(ts).cast("date"))
    best = dedupe_by(rows, [*keys, "_settled_day"], "kind")
    return best.drop("_settled_day", "kind", "run", "batch_id")
