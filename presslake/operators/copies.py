"""Articles with the same or nearly the same content under several URLs.

Exact copies share the digest of their normalised text. Near copies have 64-bit SimHashes (of three words in a row)
that differ in at most `MAX_BITS` bits. Such hashes are found without comparing all: cut into four
blocks, two of them agree in at least one whole block, and within the rest, cut into four again, in at least one of
these. So they meet under one of sixteen keys of about 28 bits. Under a key, hashes are sorted; each is
compared with its neighbours and with the first one, which grows with their number, not with its square.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE, BITS, MAX_BITS = 3, 64, 3
#: Neighbours in sorted order that a hash is compared with.
NEIGHBOURS = 4


def normalised(text: Column) -> Column:
    """Lower-case words with one blank between them; null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def exact_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, copy_of, copies): the smallest key with the same normalised text, and how many rows have it."""
    digests = df.select(key, F.md5(normalised(F.col(text))).alias("digest"))
    # Counted before anything is joined: a text with most of the rows comes as one row from each task.
    groups = digests.groupBy("digest").agg(F.min(key).alias("copy_of"), F.count(F.lit(1)).alias("copies"))
    return digests.join(groups, "digest").select(key, "copy_of", "copies")


def simhashes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, simhash): per bit, whether most of the text's shingles have it set. Texts without a word have none."""
    words = F.split(normalised(F.col(text)), " ")
    count = F.greatest(F.size("words") - (SHINGLE - 1), F.lit(1))
    shingle = lambda i: F.xxhash64(F.array_join(F.slice("words", i, SHINGLE), " "))
    cut = df.select(key, words.alias("words")).where(F.col("words")[0] != "")
    each = cut.select(key, F.explode(F.transform(F.sequence(F.lit(1), count), shingle)).alias("h"))
    # A set bit votes +1, the others -1; a tie counts as not set.
    votes = [F.sum(F.getbit("h", F.lit(i)).cast("int") * 2 - 1).alias(f"v{i}") for i in range(BITS)]
    voted = each.groupBy(key).agg(*votes)
    bits = (F.when(F.col(f"v{i}") > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(BITS))
    return voted.select(key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("simhash"))


def _cut(value: Column, low: int, size: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND((1 << size) - 1)


def block_keys(simhash: Column) -> Column:
    """Sixteen keys: a block of 16 bits, and one of 12 bits of the 48 others."""
    keys = []
    for i in range(4):
        block = _cut(simhash, 16 * i, 16)
        high = F.shiftleft(_cut(simhash, 16 * i + 16, 48 - 16 * i), 16 * i) if i < 3 else F.lit(0).cast("long")
        rest = high.bitwiseOR(_cut(simhash, 0, 16 * i)) if i else high
        keys += [F.struct(F.lit(4 * i + j).alias("table"), block.alias("block"), _cut(rest, 12 * j, 12).alias("part")) for j in range(4)]
    return F.array(*keys)


def near_hashes(hashes: DataFrame) -> DataFrame:
    """(a, b, bits), a < b: different hashes of a column `simhash` that differ in at most `MAX_BITS` bits."""
    distinct = hashes.select("simhash").distinct()
    keyed = distinct.select("simhash", F.explode(block_keys(F.col("simhash"))).alias("key")).select("simhash", "key.*")
    # Sorted by what the key leaves open; a crowded key is one range of rows, of which few are looked at.
    order = Window.partitionBy("table", "block", "part").orderBy("simhash")
    others = [F.lead("simhash", n).over(order) for n in range(1, NEIGHBOURS + 1)]
    others.append(F.first("simhash").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    met = keyed.select("simhash", F.array_distinct(F.array(*others)).alias("others"))
    pairs = met.select("simhash", F.explode("others").alias("other")).where("other IS NOT NULL AND other <> simhash")
    pairs = pairs.select(F.least("simhash", "other").alias("a"), F.greatest("simhash", "other").alias("b"))
    return pairs.withColumn("bits", F.bit_count(F.col("a").bitwiseXOR(F.col("b")))).where(F.col("bits") <= MAX_BITS).distinct()


def near_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, simhash, copy_of, near, bits): per row the smallest key with its simhash, the smallest key among near
    ones (null if none) and in how many bits that one differs."""
    hashes = simhashes(df, key, text)
    first = hashes.groupBy("simhash").agg(F.min(key).alias("copy_of"))
    links = near_hashes(hashes)
    both = links.select("a", "b", "bits").union(links.select("b", "a", "bits")).toDF("simhash", "other", "bits")
    named = both.join(first.toDF("other", "near"), "other")
    best = named.groupBy("simhash").agg(F.min(F.struct("near", "bits")).alias("best"))
    per_hash = first.join(best, "simhash", "left").select("simhash", "copy_of", "best.near", "best.bits")
    return hashes.join(per_hash, "simhash").select(key, "simhash", "copy_of", "near", "bits")
