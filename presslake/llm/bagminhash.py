"""Near duplicates by BagMinHash signatures of word-shingle multisets.

Every shingle owns a fixed Poisson process over time and weight. A text holding
it w times sees the points whose weight coordinate is below w, each point falls
on one of the signature's registers, and a register keeps its earliest point. Two
texts agree in a register with a chance equal to their weighted Jaccard similarity.

Weights are counts, so the weight axis has unit levels, grouped in the dyadic ranges
[0,1) [1,2) [2,4) [4,8) ... A range starts as one process of summed rate; its first
point belongs to one half, the other half gets a later first point of its own, and
so on down to unit levels. Ranges and points that lie above w, or later than every
register of the text, are dropped unseen, so the work is about the number of
distinct shingles plus the number of points that matter. Everything is drawn from
hashes of (shingle, range), hence equal in all texts and on all machines.

Texts that share a band of registers are candidates; a link needs an exact overlap of
multisets at the threshold. In a bucket every member is compared with the bucket's
leader first. Only buckets whose members are then still in several components
compare members of different components, less those that exact bounds rule out. So a
bucket of copies costs one comparison a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import fresh, portions, staged, text_key, tidy, whole_text, words_of
from presslake.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
#: Texts, and words or shingles, worked on at once: some ten arrays of their hashes are held. A longer text is alone.
PORTION_TEXTS, PORTION_WORDS = 128, 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31, _S11 = np.uint64(30), np.uint64(27), np.uint64(31), np.uint64(11)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (a finalizer of splitmix64)."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def _wait(bits: np.ndarray, rate: np.ndarray | float) -> np.ndarray:
    """Exponential waiting times from 64-bit integers."""
    return -np.log1p(-(bits >> _S11).astype("f8") * 2.0**-53) / rate


def shingle_hashes(words: np.ndarray, lengths: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the text each belongs to.

    A text of fewer words is one shingle of all its words; a text without words has none.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype("i8")
    counts = np.where(lengths == 0, 0, np.maximum(lengths - size + 1, 1))
    text = np.repeat(np.arange(len(lengths)), counts)
    first = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]
    end = (starts + lengths)[text]
    hashes = np.zeros(len(text), "u8")
    for i in range(size):
        at = first + i
        inside = at < end
        word = np.where(inside, words[np.minimum(at, len(words) - 1)] if len(words) else 0, np.uint64(i))
        hashes = mix(hashes * np.uint64(31) + word + _ODD)
    return hashes, text


def multisets(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with their text and count, sorted by text and shingle."""
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return h[at], t[at], np.diff(np.append(at, len(h)))


def signatures(shingles: np.ndarray, text: np.ndarray, weights: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """BagMinHash registers (times of the earliest points) of every text; infinite without shingles."""
    out = np.full((n_texts, registers), np.inf)
    flat = out.reshape(-1)
    # One row per (text, shingle, dyadic range below its weight): range = level of `size` units from `low`.
    levels = np.ones(len(weights), "i8") + np.ceil(np.log2(np.maximum(weights, 1))).astype("i8")
    who = np.repeat(np.arange(len(weights)), levels)
    level = np.arange(len(who)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0)).astype("i8")
    size = np.maximum(low, 1)
    doc, weight = text[who].astype("i8"), weights[who].astype("i8")
    seed = mix(shingles[who] + level.astype("u8") * _ODD)
    time = _wait(seed, size)
    latest = np.full(n_texts, np.inf)
    while len(doc):
        unit = size == 1
        # Points of unit ranges reach their register.
        u_doc, u_seed, u_time = doc[unit], seed[unit], time[unit]
        np.minimum.at(flat, u_doc * registers + (mix(u_seed ^ _ODD) % np.uint64(registers)).astype("i8"), u_time)
        touched = np.unique(u_doc)
        latest[touched] = out[touched].max(axis=1)
        # The next point of a unit range.
        n_seed = mix(u_seed + _ODD)
        n_time = u_time + _wait(n_seed, 1.0)
        # Wider ranges split: the first point goes to one half, the other half waits anew.
        wide = ~unit
        half = size[wide] >> 1
        w_seed, w_low = seed[wide], low[wide]
        upper = (mix(w_seed + np.uint64(3)) & np.uint64(1)).astype("i8")
        same_seed, other_seed = mix(w_seed + np.uint64(5)), mix(w_seed + np.uint64(7))
        doc = np.concatenate([u_doc, doc[wide], doc[wide]])
        weight = np.concatenate([weight[unit], weight[wide], weight[wide]])
        low = np.concatenate([low[unit], w_low + upper * half, w_low + (1 - upper) * half])
        size = np.concatenate([size[unit], half, half])
        seed = np.concatenate([n_seed, same_seed, other_seed])
        time = np.concatenate([n_time, time[wide], time[wide] + _wait(other_seed, half)])
        live = (low < weight) & (time < latest[doc])
        doc, weight, low, size, seed, time = (x[live] for x in (doc, weight, low, size, seed, time))
    return out


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(registers).view("u8").reshape(len(registers), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype="u8") * _ODD, bits.shape[:2]).copy()
    for i in range(rows):
        out = mix(out * np.uint64(31) + bits[:, :, i] + _ODD)
    return out.view("i8")


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets of hashes."""
    if not len(a) or not len(b):
        return 0.0
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(nx[i], ny[j]).sum())
    return common / (len(a) + len(b) - common)


def _word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(np.asarray(column.offsets)).astype("i8")
    return np.asarray(column.flatten()).view("u8"), lengths


def _word_portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches (key, words) of so many texts and words at most."""
    for batch in batches:
        for part in range(0, batch.num_rows, PORTION_TEXTS):
            piece = batch.slice(part, PORTION_TEXTS)
            yield from portions(piece, np.diff(np.asarray(piece.column("words").offsets)), PORTION_WORDS)


def sketches(texts: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE_WORDS) -> DataFrame:
    """For texts (key, body): key, the number of shingles and the band hashes; texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _word_portions(batches):
            words, lengths = _lists(piece.column("words"))
            hashes, text = shingle_hashes(words, lengths, size)
            n = np.bincount(text, minlength=len(lengths))
            keys, some = piece.column("key"), n > 0
            registers = signatures(*multisets(hashes, text), len(lengths), bands * rows)
            bits = band_hashes(registers[some], bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.filter(pa.array(some)),
                    pa.array(n[some], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * bands, pa.int32()), pa.array(bits.reshape(-1))),
                ],
                names=["key", "n", "bands"],
            )

    prepared = texts.select("key", _word_hashes(F.col("body")).alias("words"))
    return prepared.mapInArrow(tidy(run), "key binary, n long, bands array<long>")


def shingle_lists(texts: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """For texts (key, body): key and the sorted hashes of all shingles as bytes."""

    prepared = texts.select("key", _word_hashes(F.col("body")).alias("words"))
    return prepared.mapInArrow(tidy(lambda batches: _sorted_shingles(batches, size)), "key binary, shingles binary")


def _sorted_shingles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for piece in _word_portions(batches):
        words, lengths = _lists(piece.column("words"))
        hashes, text = shingle_hashes(words, lengths, size)
        order = np.lexsort((hashes, text))
        cuts = np.cumsum(np.bincount(text, minlength=len(lengths)))[:-1]
        lists = [part.tobytes() for part in np.split(hashes[order], cuts)]
        yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(lists, pa.binary())], names=["key", "shingles"])


def _verified(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs (a, b) with their exact similarity `sim`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            sims = [
                overlap(np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8"))
                for x, y in zip(left, right, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], names=["a", "b", "sim"])

    left = lists.select(F.col("key").alias("a"), F.col("shingles").alias("left"))
    right = lists.select(F.col("key").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(tidy(run), "a binary, b binary, sim double")


def near_links(
    texts: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE_WORDS
) -> tuple[DataFrame, DataFrame]:
    """For texts (key, body), equal keys meaning equal bodies: verified links (a, b, sim), and component roots.

    The links connect all texts that any candidate pair at the threshold connects.
    Pairs inside a component that are already connected are not expanded.
    """
    sketch = staged(sketches(texts, bands, rows, size).dropDuplicates(["key"]), "sketches")
    members = sketch.select("key", "n", F.posexplode("bands").alias("band", "bucket"))
    # Aggregates are staged before they meet their own rows again: a join of two plain
    # tables is one whose large partitions Spark can split.
    crowded = staged(
        members.groupBy("band", "bucket")
        .agg(F.min(F.struct("key", "n")).alias("lead"), F.max("key").alias("last"))
        .filter(F.col("lead.key") < F.col("last"))
        .select("band", "bucket", "lead"),
        "buckets",
    )
    crowd = staged(
        members.join(crowded, ["band", "bucket"]).select("band", "bucket", "key", "n", "lead"), "crowded-buckets"
    )
    fits = F.least("n", "lead.n") >= threshold * F.greatest("n", "lead.n")
    to_lead = staged(
        crowd.filter((F.col("key") > F.col("lead.key")) & fits)
        .select(F.col("lead.key").alias("a"), F.col("key").alias("b"))
        .distinct(),
        "leader-pairs",
    )
    wanted = crowd.select("key").distinct()
    lists = staged(shingle_lists(texts.join(wanted, "key", "left_semi").dropDuplicates(["key"]), size), "shingle-lists")
    led = staged(_verified(to_lead, lists), "led")
    links = led.filter(F.col("sim") >= threshold)

    # A second leader for buckets still in several components: the member with the fewest shingles
    # of its own, as a rule the text the others are copies of.
    roots = components(links)
    members = _hopeful(_still_open(crowd, roots), lists, threshold)
    centre = staged(
        members.groupBy("band", "bucket").agg(F.min(F.struct((F.col("n") - F.col("shared")).alias("own"), "key")).alias("c"))
        .select("band", "bucket", F.col("c.key").alias("centre")),
        "centres",
    )
    members = staged(members.join(centre, ["band", "bucket"]), "centred")
    to_centre = (
        members.filter(F.col("key") != F.col("centre"))
        .select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b"))
        .distinct()
        .join(to_lead, ["a", "b"], "left_anti")
    )
    centred = staged(_verified(to_centre, lists), "centre-led")
    led = led.unionByName(centred)
    roots = components(centred.filter(F.col("sim") >= threshold), roots)

    # What is still in several components is compared across them.
    rest = _still_open(members.drop("root", "low"), roots)
    cross = _cross_pairs(rest, led, threshold)
    crossed = staged(_verified(staged(cross, "cross-pairs"), lists).filter(F.col("sim") >= threshold), "crossed")
    all_links = led.filter(F.col("sim") >= threshold).unionByName(crossed)
    return all_links, components(crossed, roots)


def _still_open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (band, bucket, key, n) of buckets with several components: with root, and the bucket's lowest root,
    smallest text and size."""
    placed = members.drop("least_n", "size").join(roots.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("root", F.coalesce("root", "key"))
    buckets = staged(
        placed.groupBy("band", "bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("least_n"), F.count(F.lit(1)).alias("size"))
        .filter("low < high")
        .drop("high"),
        "open-buckets",
    )
    return staged(placed.join(buckets, ["band", "bucket"]), "open")


def _own_shingles(lists: DataFrame) -> DataFrame:
    """For each key of `lists` that has any: how many of its shingles no other key of `lists` has."""
    shingles = lists.mapInArrow(tidy(_single_shingles), "key binary, shingle long, n long")
    held = shingles.groupBy("shingle").agg(F.min("key").alias("key"), F.max("key").alias("other"), F.first("n").alias("n"))
    return held.filter(F.col("key") == F.col("other")).groupBy("key").agg(F.sum("n").alias("own"))


def _single_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches (key, shingles): a row per distinct shingle of a key. They are several times the size of what comes in."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("shingles")).to_numpy(zero_copy_only=False) // 8
        for piece in portions(batch, sizes, PORTION_WORDS):
            keys, parts, counts = piece.column("key"), [], []
            for value in piece.column("shingles"):
                part, count = np.unique(np.frombuffer(value.as_buffer(), "u8"), return_counts=True)
                parts.append(part)
                counts.append(count)
            at = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at)), pa.array(np.concatenate(parts).view("i8")), pa.array(np.concatenate(counts))],
                    names=["key", "shingle", "n"],
                )


def _most_alike(shared, sizes):
    """The similarity two texts of `sizes` shingles together have at most, with `shared` in common at most."""
    return shared / (sizes - shared) + 1e-9


def _hopeful(members: DataFrame, lists: DataFrame, threshold: float, crowd: int = 16) -> DataFrame:
    """Members with `shared`, the shingles they may have in common with others, less those that can have no link.

    Shingles that no other text of a crowded bucket has cannot be common to two texts there.
    In buckets up to `crowd` members all shingles count as shared, which rules out less.
    """
    crowded = members.filter(F.col("size") > crowd).select("key").distinct()
    own = staged(_own_shingles(lists.join(crowded, "key", "left_semi")), "own-shingles")
    counted = members.join(own, "key", "left").withColumn(
        "shared", F.when(F.col("size") > crowd, F.col("n") - F.coalesce("own", F.lit(0))).otherwise(F.col("n"))
    )
    # The best partner is the smallest text that can hold all of `shared`; none in the bucket is smaller than least_n.
    best = _most_alike(F.col("shared"), F.col("n") + F.greatest("least_n", "shared"))
    return staged(counted.drop("own").filter(best >= threshold), "hopeful")


def _cross_pairs(members: DataFrame, led: DataFrame, threshold: float) -> DataFrame:
    """Pairs of members of different components of a bucket that may reach the threshold and are not verified yet.

    Ruled out, without losing a link: pairs whose distances to the centre differ too
    much (the Jaccard distance is a metric), whose sizes differ too much, or who share too
    little. A bucket's component with the lowest root is compared with the others, not with itself.
    """
    to_centre = members.withColumn("a", F.least("key", "centre")).withColumn("b", F.greatest("key", "centre"))
    known = to_centre.join(led, ["a", "b"], "left").drop("a", "b", "centre", "size", "least_n")
    # A pair is made in the first bucket its members share: each knows its buckets, one a band at most.
    all_buckets = members.groupBy("key").agg(F.array_sort(F.collect_set("bucket")).alias("buckets"))
    known = staged(known.join(all_buckets, "key"), "cross-members")
    columns = ("key", "n", "root", "sim", "shared", "buckets")
    other = known.select("band", "bucket", *[F.col(c).alias(f"o_{c}") for c in columns])
    apart = F.coalesce(F.abs(F.col("sim") - F.col("o_sim")) > 1 - threshold + 1e-9, F.lit(False))
    pairs = known.filter("root <> low").join(other, ["band", "bucket"]).filter(
        (F.col("root") != F.col("o_root"))
        & ((F.col("o_root") == F.col("low")) | (F.col("key") < F.col("o_key")))
        & (F.least("n", "o_n") >= threshold * F.greatest("n", "o_n"))
        & (_most_alike(F.least("shared", "o_shared"), F.col("n") + F.col("o_n")) >= threshold)
        & ~apart
        & (F.element_at(F.array_intersect("buckets", "o_buckets"), 1) == F.col("bucket"))
    )
    # Two members that are both outside the lowest component meet once; distinct is for hash ties between bands.
    pairs = pairs.select(F.least("key", "o_key").alias("a"), F.greatest("key", "o_key").alias("b")).distinct()
    return pairs.join(led.select("a", "b"), ["a", "b"], "left_anti")


def near_classes(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    size: int = SHINGLE_WORDS,
) -> DataFrame:
    """Every row of `df` with its class of near duplicates, in three added columns.

    Added: class_id (smallest id in the class), class_size (rows in the class), kept.
    When `df` already has such a column, an underscore is put before the added one.

    A class is a connected component of texts whose multisets of `size`-word shingles
    have a weighted Jaccard similarity of `threshold` or more. Texts of fewer words
    are one shingle. Texts without words (also null and empty ones) are only like
    texts that are exactly equal. The row with the smallest id stays; rows without an id
    lose against rows with one, and a class without any id keeps one row with a null
    class_id. Of repeated rows with the smallest id one stays. Copies follow
    their text. An empty table gives an empty table.
    """
    class_id, class_size, stays = fresh(df, "class_id", "class_size", "kept")
    key, root, pick = fresh(df, "text_key", "text_root", "pick")
    keyed = df.withColumn(key, text_key(whole_text(text_col)))
    texts = df.select(text_key(whole_text(text_col)).alias("key"), whole_text(text_col).alias("body"))
    _, roots = near_links(texts, threshold, bands, rows, size)
    roots = staged(roots.select(F.col("node").alias(key), F.col("root").alias(root)), "text-roots")
    # Pre-aggregated: per text its rows and smallest id, then per class.
    per_text = staged(
        keyed.groupBy(key).agg(F.min(F.col(f"`{id_col}`")).alias("low"), F.count(F.lit(1)).alias("n")), "per-text"
    )
    placed = per_text.join(roots, key, "left").withColumn(root, F.coalesce(root, key))
    per_class = staged(
        placed.groupBy(root).agg(
            F.sum("n").alias("total"),
            F.min(F.struct(F.col("low").isNull().alias("none"), "low", F.col(key).alias("text"))).alias("first"),
        ),
        "per-class",
    )
    decided = staged(
        placed.join(per_class, root).select(
            F.col(key),
            F.col("first.low").alias(class_id),
            F.col("total").alias(class_size),
            (F.col("first.text") == F.col(key)).alias(pick),
            F.col("n").alias("copies"),
            (F.col("total") > 1).alias("grouped"),
        ),
        "classes",
    )
    placed_rows = keyed.join(decided, key)
    columns = [F.col(f"`{c}`") for c in df.columns] + [F.col(class_id), F.col(class_size)]
    here = F.col(f"`{id_col}`")
    leads = F.col(pick) & here.eqNullSafe(F.col(class_id))
    # Only copies of the leading text can tie on the smallest id.
    single = placed_rows.filter(~leads | (F.col("copies") == 1)).select(*columns, leads.alias(stays))
    tied = placed_rows.filter(leads & (F.col("copies") > 1)).select(*columns, F.col(key))
    return single.unionByName(_one_stays(tied, key, columns, stays, df.columns, class_id, class_size))


def _one_stays(tied: DataFrame, key: str, columns: list, stays: str, names: list[str], class_id: str, class_size: str) -> DataFrame:
    """Rows of the leading text with the smallest id (copies of one row): the first of each group stays."""
    rows = staged(tied.withColumn("tie", F.monotonically_increasing_id()), "tied-rows")
    first = rows.groupBy(F.col(key).alias("tie_key")).agg(F.min("tie").alias("first_tie"))
    return rows.join(first, F.col(key) == F.col("tie_key")).select(
        *[F.col(f"`{c}`") for c in [*names, class_id, class_size]], (F.col("tie") == F.col("first_tie")).alias(stays)
    )
