"""Exact duplicates by deterministic block naming, with DataFrame functions only.

A text is cut into blocks of a fixed length. The distinct blocks are sorted and
numbered, so equal blocks, and only those, share an integer name. Then each pair
of neighbouring names gets a name of its own in the same way, level by level,
until one name is left for a text. Two texts of as many blocks have the same
last name exactly when they are equal: no step relies on hashes being distinct.

A 64-bit hash of each text decides beforehand which rows need naming at all: a
row whose hash no other row has equals no other text and is a class of its own.
Hash collisions only send more rows through the naming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import fresh, staged, whole_text

BLOCK_CHARS = 4096


def _named(keys: DataFrame, name: str) -> DataFrame:
    """The distinct rows of `keys`, sorted within hash partitions, each with an integer name.

    The names are written down before anything uses them. Rows of a partition
    are distinct and sorted, so a repeated task gives the same names.
    """
    distinct = keys.distinct()
    return staged(distinct.sortWithinPartitions(*distinct.columns).withColumn("name", F.monotonically_increasing_id()), name)


def block_names(rows: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """For rows (rid, body): rid, n_blocks and the integer `name` of the whole body.

    Bodies are equal exactly when n_blocks and name are both equal. An empty body has
    one empty block.
    """
    n_blocks = F.greatest(F.ceil(F.length("body") / F.lit(block_chars)), F.lit(1)).cast("int")
    blocks = rows.select("rid", n_blocks.alias("n_blocks"), "body").select(
        "rid",
        "n_blocks",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.col("n_blocks") - 1),
                lambda i: F.substring(F.col("body"), i * block_chars + 1, F.lit(block_chars)),
            )
        ).alias("pos", "block"),
    )
    names = _named(blocks.select("block"), "block-names")
    level = staged(blocks.join(names, "block").select("rid", "n_blocks", "pos", "name"), "level")
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    done = level.filter("n_blocks = 1").select("rid", "n_blocks", "name")
    span = 1
    while span < most:
        # Positions 2i and 2i+1 meet in one row; a last name without a partner meets -1.
        pairs = (
            level.filter(F.col("n_blocks") > span)
            .groupBy("rid", "n_blocks", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))), F.lit(-1)).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        names = _named(pairs.select("left", "right"), "pair-names")
        level = staged(pairs.join(names, ["left", "right"]).select("rid", "n_blocks", "pos", "name"), "level")
        done = done.unionByName(
            level.filter((F.col("n_blocks") > span) & (F.col("n_blocks") <= 2 * span)).select("rid", "n_blocks", "name")
        )
        span *= 2
    return done


def exact_classes(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Every row of `df` with the class of its text, in three added columns.

    Added: keep_id (id of the row that stays), group_size, kept. When `df` already
    has such a column, an underscore is put before the added one.

    Of equal texts the row with the largest id stays. A null text is an empty
    text. Rows without an id lose against rows with one; of rows with the same
    largest id exactly one stays. An empty table gives an empty table.
    """
    keep_id, group_size, kept, sig, rid, body = fresh(df, "keep_id", "group_size", "kept", "sig", "rid", "body")
    tagged = df.withColumn(sig, F.xxhash64(whole_text(text_col)))
    # Narrow and staged, so Spark knows its size and broadcasts it only when small.
    repeated = staged(tagged.groupBy(sig).count().filter("count > 1").select(sig), "repeated")
    alone = tagged.join(repeated, sig, "left_anti").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col(f"`{id_col}`").alias(keep_id),
        F.lit(1).cast("long").alias(group_size),
        F.lit(True).alias(kept),
    )
    rows = staged(
        tagged.join(repeated, sig, "left_semi").drop(sig).withColumn(rid, F.monotonically_increasing_id()), "repeated-rows"
    )
    named = block_names(
        rows.select(F.col(rid).alias("rid"), whole_text(text_col).alias("body")), block_chars
    ).withColumnRenamed("rid", "name_rid")
    ids = staged(
        rows.select(F.col(rid).alias("row_rid"), F.col(f"`{id_col}`").alias("row_id"))
        .join(named, F.col("row_rid") == F.col("name_rid"))
        .select("row_rid", "row_id", "n_blocks", "name"),
        "named-rows",
    )
    # One row per class and task reaches the shuffle; nulls sort first. Staged on its own, the
    # join below is between two plain tables, whose large partitions Spark can split.
    groups = staged(
        ids.groupBy("n_blocks", "name").agg(
            F.max(F.struct("row_id", F.negative("row_rid").alias("tie"))).alias("top"), F.count(F.lit(1)).alias("size")
        ),
        "text-groups",
    )
    decided = ids.join(groups, ["n_blocks", "name"]).select(
        "row_rid",
        F.col("top.row_id").alias("top_id"),
        F.col("size"),
        (F.negative("row_rid") == F.col("top.tie")).alias("stays"),
    )
    again = rows.join(decided, F.col(rid) == F.col("row_rid")).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("top_id").alias(keep_id),
        F.col("size").alias(group_size),
        F.col("stays").alias(kept),
    )
    return alone.unionByName(again)
