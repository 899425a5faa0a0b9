"""Substring search without reading the archive: postings of three-character sequences, kept up batch by batch.

An index folder holds three tables:

* `docs`: the rows, in blocks of at most `BLOCK_ROWS` rows of one day; a row is found by (attempt, day, block, slot);
* `postings`: for each sequence ("gram") and block the slots of the rows that hold it, by day, sorted by gram;
* `batches`: the batches that were written in full, and by which attempt. What a broken attempt left behind is not
  listed and never shown.

A search reads the postings of its term's grams, intersects them block by block and reads only the blocks with
candidates, in which the term itself is then looked for, so the result is that of a scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.match import bind
from presslake.sources.tables import read_or_empty

BLOCK_ROWS = 4096
GRAM = 3
DAY = "collection_date"
#: Candidates up to this number are broadcast to the scan of `docs`, which then skips all other blocks.
FEW = 100_000
#: Stands behind the end of a text, so that a gram begins at every character.
PAD = "\u0000"

BATCHES = "batch string, attempt string"
PLACE = ["attempt", DAY, "block"]


def grams(text: Column) -> Column:
    """All sequences of three characters of a lower-case text, each once; the last two are filled up."""
    chars = F.concat(F.split(text, ""), F.array(F.lit(PAD), F.lit(PAD)))

    def starts(cs: Column) -> Column:
        # A slice per offset, so that a long text is walked three times, not once per character.
        size = F.size(cs) - 2
        second, third = F.slice(cs, 2, size), F.slice(cs, 3, size)
        both = lambda a, b: F.concat(a, b)
        return F.array_distinct(F.zip_with(F.zip_with(F.slice(cs, 1, size), second, both), third, both))

    return F.when(text == "", F.array().cast("array<string>")).otherwise(bind(chars, starts))


def _gram_codes(text: str) -> np.ndarray:
    """The grams of a text as numbers of 63 bits, 21 for each character."""
    if not text:
        return np.zeros(0, "i8")
    c = np.frombuffer((text + PAD * (GRAM - 1)).encode("utf-32-le"), "u4").astype("i8")
    return c[:-2] << 42 | c[1:-1] << 21 | c[2:]


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: for each gram and block the slots of the rows that hold it, as `grams` gives them for the row's fields."""
    for batch in batches:
        fields = [batch.column(i) for i in range(3, batch.num_columns)]
        slots = batch.column("slot").to_numpy(zero_copy_only=False)
        blocks: dict[tuple, list[int]] = {}
        for row, place in enumerate(zip(batch.column(0).to_pylist(), batch.column("block").to_pylist(), strict=True)):
            blocks.setdefault(place, []).append(row)
        for rows in blocks.values():
            own = [np.unique(np.concatenate([_gram_codes(f[row].as_py()) for f in fields])) for row in rows]
            codes, owner = np.concatenate(own), np.repeat(rows, [len(o) for o in own])
            order = np.argsort(codes, kind="stable")
            codes, held = codes[order], slots[owner[order]].astype("i4")
            starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, "i8")
            mask = (1 << 21) - 1
            chars = np.stack([codes[starts] >> 42, codes[starts] >> 21 & mask, codes[starts] & mask], axis=1).astype("u4")
            shown = chars.tobytes().decode("utf-32-le")
            first = pa.array(np.full(len(starts), rows[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(first),
                    batch.column(1).take(first),
                    pa.array([shown[i : i + GRAM] for i in range(0, len(shown), GRAM)], pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.append(starts, len(codes)).astype("i4")), pa.array(held)),
                ],
                names=[DAY, "block", "gram", "slots"],
            )


def term_grams(term: str) -> list[str]:
    return sorted({term[i : i + GRAM] for i in range(len(term) - GRAM + 1)})


def append(batch: DataFrame, path: str, name: str, fields: Sequence[str] = ("title", "description")) -> bool:
    """Adds rows with a `collection_date` and text `fields` to the index at `path`; False if batch `name` is already there.

    All columns are kept for the results. A batch that broke off is simply written again. Nothing of
    earlier batches is read, but for the list of their names.
    """
    spark = batch.sparkSession
    if _listed(spark, path).where(F.col("batch") == name).limit(1).count():
        return False
    attempt = f"a{uuid.uuid4().hex}"
    # Rows of a day come together; a day with most rows is split over several tasks. A task numbers its rows.
    numbered = batch.hint("rebalance", DAY).withColumn("slot", F.monotonically_increasing_id())
    in_task = F.col("slot").bitwiseAND((1 << 33) - 1)
    block = F.concat_ws("-", F.shiftright("slot", 33).cast("string"), F.floor(in_task / BLOCK_ROWS).cast("string"))
    numbered = numbered.withColumns({"block": F.concat(F.lit("b"), block), "slot": (in_task % BLOCK_ROWS).cast("int")})
    docs = f"{path}/docs/attempt={attempt}"
    numbered.write.partitionBy(DAY, "block").parquet(docs)
    written = spark.read.schema(numbered.schema).parquet(docs)
    low = [F.lower(F.coalesce(f, F.lit(""))).alias(f"field_{i}") for i, f in enumerate(fields)]
    kind = written.schema[DAY].dataType.simpleString()
    lists = written.select(DAY, "block", "slot", *low).mapInArrow(_lists, f"{DAY} {kind}, block string, gram string, slots array<int>")
    # A batch of rows has one list per gram and block; a block's lists are put together.
    lists = lists.groupBy(DAY, "gram", "block").agg(F.sort_array(F.flatten(F.collect_list("slots"))).alias("slots"))
    lists = lists.repartitionByRange(DAY, "gram").sortWithinPartitions(DAY, "gram")
    lists.write.partitionBy(DAY).parquet(f"{path}/postings/attempt={attempt}")
    spark.createDataFrame([(name, attempt)], BATCHES).write.mode("append").parquet(f"{path}/batches")
    return True


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/batches", BATCHES)


def _shown(table: DataFrame, path: str, date: str) -> DataFrame:
    """Rows of finished batches, of one date if given."""
    if date:
        table = table.where(F.col(DAY) == F.lit(date).cast("date"))
    return table.join(_listed(table.sparkSession, path).select("attempt").distinct(), "attempt", "left_semi")


def candidates(spark: SparkSession, path: str, terms: Sequence[str], date: str = "") -> DataFrame:
    """(term, attempt, collection_date, block, slot) of all rows that hold every gram of a lower-case term, and of some more.

    A term of one or two characters is looked up by the grams that begin with it.
    """
    keys = [(t, key, len(t) < GRAM, max(1, len(term_grams(t)))) for t in terms for key in term_grams(t) or [t]]
    # As many rows as the terms given have characters.
    wanted = F.broadcast(spark.createDataFrame(keys, "term string, key string, short boolean, grams int"))
    whole = sorted({key for _, key, short, _ in keys if not short})
    tests = [F.col("gram").isin(whole)] * bool(whole) + [F.col("gram").startswith(t) for t in terms if len(t) < GRAM]
    hits = _shown(spark.read.parquet(f"{path}/postings").where(reduce(Column.__or__, tests)), path, date)
    starts = F.array("gram", *(F.left("gram", F.lit(n)) for n in range(1, GRAM)))
    lists = hits.withColumn("key", F.explode(F.array_distinct(starts))).join(wanted, "key")
    lists = lists.groupBy("term", *PLACE, "short", "grams").agg(F.collect_list("slots").alias("lists"))
    # A block has one list per gram of a term: as many as there are grams, if all occur.
    met = lists.where(F.col("short") | (F.size("lists") == F.col("grams")))
    common = F.aggregate("lists", F.col("lists")[0], lambda all_of, more: F.array_intersect(all_of, more))
    slots = F.when(F.col("short"), F.array_distinct(F.flatten("lists"))).otherwise(common)
    return met.select("term", *PLACE, F.explode(slots).alias("slot"))


def search_terms(
    spark: SparkSession, path: str, terms: Sequence[str], date: str = "", fields: Sequence[str] = ("title", "description")
) -> DataFrame:
    """Indexed rows with a term, in any case, in one of the `fields`, once per `term` of the list that they hold.

    All terms are looked up in one pass over the postings. An empty term is in all rows (of the
    date). `fields` are among those that were indexed; at least one batch has been.
    """
    docs = spark.read.parquet(f"{path}/docs")
    low = {t: t.lower() for t in dict.fromkeys(terms)}
    parts = []
    if "" in low:
        parts.append(_shown(docs, path, date).withColumn("term", F.lit("")))
    looked_up = sorted({t for t in low.values() if t})
    if looked_up:
        found = candidates(spark, path, looked_up, date).withColumnRenamed("term", "low_term")
        # Counting stops at the bound. The scan of `docs` then skips the blocks that the broadcast side does not name.
        few = found.limit(FEW + 1).count() <= FEW
        rows = docs.join(F.broadcast(found) if few else found, [*PLACE, "slot"])
        holds = lambda f: F.contains(F.lower(F.coalesce(f, F.lit(""))), F.col("low_term"))
        named = spark.createDataFrame([(t, v) for t, v in low.items() if v], "term string, low_term string")
        rows = rows.where(reduce(Column.__or__, map(holds, fields)))
        parts.append(rows.join(F.broadcast(named), "low_term").drop("low_term"))
    return reduce(DataFrame.unionByName, parts).drop("attempt", "block", "slot")


def search(spark: SparkSession, path: str, term: str, date: str = "", fields: Sequence[str] = ("title", "description")) -> DataFrame:
    """Indexed rows with the term, in any case, in one of the `fields`; see `search_terms`."""
    return search_terms(spark, path, [term], date, fields).drop("term")
