"""Feed success rates and broken feeds, from the streaks of a fetch log.

A streak is a run of fetches of one source with the same outcome. Streaks are found within slices of time, so a
source with most of the fetches is dealt over as many tasks as it has slices; only the first and the last streak of a
slice meet their neighbours of other slices.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Failed fetches in a row, hours without a success, and success rate that make a feed broken.
BROKEN_STREAK, BROKEN_HOURS, BROKEN_RATE = 5, 72, 0.5
#: Seconds of a slice.
SLICE = 6 * 3600


def _islands(rows: DataFrame, by: list[str], order: list[str], continues: Column) -> DataFrame:
    """`island`: a number that grows, along `order` within `by`, at every row that does not continue the one before."""
    along = Window.partitionBy(*by).orderBy(*order)
    new = F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1)
    return rows.withColumn("_new", new).withColumn("island", F.sum("_new").over(along)).drop("_new")


def feed_streaks(log: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """One row per streak of a fetch log (source, ts, fetch_id, ok): source, ok, started, ended, fetches, and
    `before`, the time of the last fetch with the other outcome (null for a source's first streak).

    Fetches of a source follow each other by time (null first), then by id. A null outcome is a failure.
    """
    rows = log.select("source", "ts", "fetch_id", F.coalesce("ok", F.lit(False)).alias("ok"))
    dealt = rows.withColumn("part", F.floor(F.unix_seconds("ts") / slice_seconds))
    here = Window.partitionBy("part", "source").orderBy("ts", "fetch_id")
    marked = dealt.withColumn("last_ts", F.lag("ts").over(here)).withColumn("same", F.lag("ok").over(here) == F.col("ok"))
    numbered = _islands(marked, ["part", "source"], ["ts", "fetch_id"], F.col("same"))
    found = numbered.groupBy("part", "source", "island").agg(
        F.first("ok").alias("ok"), F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("fetches"),
        # The time before its first row; of equal times any has the same.
        F.min("last_ts").alias("before"),
    )
    # The first streak of a slice has no row before it there: what is earliest is its own first row.
    found = found.withColumn("before", F.when(F.col("island") > 1, F.col("before")))
    found = found.withColumn("islands", F.max("island").over(Window.partitionBy("part", "source")))
    edge = (F.col("island") == 1) | (F.col("island") == F.col("islands"))
    columns = ["source", "ok", "started", "ended", "fetches", "before"]
    inner = found.where(~edge).select(*columns)
    across = Window.partitionBy("source").orderBy("part", "island")
    other_part = ~F.lag("part").over(across).eqNullSafe(F.col("part"))
    edges = found.where(edge).withColumn("continues", other_part & (F.lag("ok").over(across) == F.col("ok")))
    edges = edges.withColumn("before", F.when(F.col("island") > 1, F.col("before")).otherwise(F.lag("ended").over(across)))
    joined = _islands(edges, ["source"], ["part", "island"], F.col("continues")).withColumnRenamed("island", "streak")
    whole = joined.groupBy("source", "streak").agg(
        F.first("ok").alias("ok"), F.min("started").alias("started"), F.max("ended").alias("ended"),
        F.sum("fetches").alias("fetches"), F.min_by("before", F.struct("part", "started")).alias("before"),
    )
    return inner.unionByName(whole.select(*columns))


def feed_rates(streaks: DataFrame, as_of: datetime) -> DataFrame:
    """Per source: fetches, failures, success rate, longest and current streak of failures, last success, hours since then,
    whether the feed is broken, and why: `streak`, `silent` (no success for long, or never) or `rate`."""
    last = F.max(F.struct("ended", "started", "ok", "fetches"))
    rates = streaks.groupBy("source").agg(
        F.sum("fetches").alias("fetches"),
        F.sum(F.when(~F.col("ok"), F.col("fetches")).otherwise(0)).alias("failures"),
        F.max(F.when(~F.col("ok"), F.col("fetches")).otherwise(0)).alias("longest_failure"),
        F.max(F.when(F.col("ok"), F.col("ended"))).alias("last_success"),
        last.alias("last"),
    )
    hours = (F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("last_success")) / 3600
    rates = rates.withColumns(
        {
            "success_rate": F.round(1 - F.col("failures") / F.col("fetches"), 6),
            "current_failure": F.when(F.col("last.ok"), 0).otherwise(F.col("last.fetches")).cast("long"),
            "hours_since_success": F.floor(hours).cast("long"),
        }
    ).drop("last")
    silent = F.col("hours_since_success").isNull() | (F.col("hours_since_success") >= BROKEN_HOURS)
    why = (
        F.when(F.col("current_failure") >= BROKEN_STREAK, "streak")
        .when(silent, "silent")
        .when(F.col("success_rate") < BROKEN_RATE, "rate")
    )
    return rates.withColumn("reason", why).withColumn("broken", F.col("reason").isNotNull())
