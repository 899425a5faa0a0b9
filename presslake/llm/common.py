"""Helpers the operators share: staged tables, text columns, small schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    The lineage ends at files every executor can read, so a lost executor costs
    only the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(col: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(f"`{col}`"), F.lit(""))


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def text_key(text: Column) -> Column:
    """16 bytes that identify a text (half of its SHA-256)."""
    return F.unhex(F.left(F.sha2(text, 256), F.lit(32)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of `df` (ignoring case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        free = name
        while free.lower() in taken:
            free = "_" + free
        taken.add(free.lower())
        out.append(free)
    return out


def portions(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose rows' `sizes` add up to `most` at most, a larger row alone but for empty ones."""
    low = held = 0
    for i, own in enumerate(sizes.tolist()):
        if held and held + own > most:
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += own
    if low < batch.num_rows:
        yield batch.slice(low)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, at whose end a worker returns what it has freed: workers outlive their tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    return tidied


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A supplied table, or the named columns of it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
