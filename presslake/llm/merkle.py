"""Merkle manifest of a table: one root for all rows, and a proof for each.

Time-forward processing. Every node has a label (level, group, node) in an order in
which children come before parents. A sweep in label order delivers the digests of
children to their parents through an external priority queue: messages sorted by
the label of their receiver, a level after the other, dealt by range so that a task
finds all messages of its nodes side by side. A second sweep in reversed order
delivers to every child the rest of the proof from its parent. Proofs meet runs of
sixteen nodes, never single rows, until the last step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import staged
from presslake.llm.places import placed

FAN_OUT = 16
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its length, so that no two rows are written alike; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(columns: Sequence[str], changed: dict[str, Column] | None = None) -> Column:
    return digest(*(field((changed or {}).get(c, F.col(f"`{c}`"))) for c in columns))


def deliver(messages: DataFrame, size: int) -> DataFrame:
    """Runs of up to `FAN_OUT` nodes (group, node, n, digest) with all their children in order.

    `messages` are (group, place, n, digest and others): what child `place` of the `n` nodes of
    its group says. A group's only node has no parent; it is handed on unchanged.
    """
    queue = messages.withColumn("node", F.floor(F.col("place") / FAN_OUT).cast("long"))
    # The queue: sorted by the receiver's label, spilled to disk, never more than a run at a time in memory.
    queue = queue.repartitionByRange(size, "group", "node").sortWithinPartitions("group", "node", "place")
    rest = [c for c in messages.columns if c not in ("group", "n", "place")]
    kids = F.sort_array(F.collect_list(F.struct("place", *rest)))
    runs = queue.groupBy("group", "node").agg(F.first("n").alias("n"), kids.alias("kids"))
    joined = F.array_join(F.transform("kids", lambda k: k["digest"]), "")
    return runs.withColumn("digest", F.when(F.col("n") == 1, joined).otherwise(F.sha2(joined, 256)))


def forward(leaves: DataFrame, size: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and the top (group, digest) of each group.

    Groups that are down to one node leave the sweep; only the count of rows that are left comes to the driver.
    """
    levels, messages, tops = [], leaves, None
    while True:
        runs = staged(deliver(messages, size), f"{name}-runs")
        levels.append(runs)
        above = F.ceil(F.col("n") / FAN_OUT).cast("long")
        done = runs.filter(above == 1).select("group", "digest")
        tops = done if tops is None else tops.unionByName(done)
        messages = runs.filter(above > 1).select("group", F.col("node").alias("place"), above.alias("n"), "digest")
        left = messages.count()
        if not left:
            return levels, tops
        size = max(1, min(size, left // 4096 + 1))


def backward(levels: list[DataFrame], rest: DataFrame, name: str) -> DataFrame:
    """The lowest runs with `proof`, the steps from their children's run to the root.

    `rest` is (group, proof and others): what follows above each group's top, and what else all below
    it are told. A step has the siblings before and after a node; applied in turn they give the root.
    """
    told = [c for c in rest.columns if c not in ("group", "proof")]
    proofs = None
    for depth in range(len(levels) - 1, -1, -1):
        runs = levels[depth]
        heard = runs.filter(F.ceil(F.col("n") / FAN_OUT) == 1).join(rest, "group")
        if proofs is not None:
            heard = heard.unionByName(runs.join(proofs, ["group", "node"]))
        if depth == 0:
            return heard
        kids = heard.select("group", *told, F.explode(with_steps()).alias("kid"))
        proofs = kids.select("group", F.col("kid.place").alias("node"), F.col("kid.proof").alias("proof"), *told)
        proofs = staged(proofs, f"{name}-proofs")


def with_steps() -> Column:
    """The children of a run, each with its own step put before the run's proof."""

    def step(kid: Column) -> Column:
        side = lambda test: F.array_join(
            F.transform(F.filter("kids", lambda k: test(k["place"], kid["place"])), lambda k: k["digest"]), ""
        )
        own = F.array(F.struct(side(lambda a, b: a < b).alias("left"), side(lambda a, b: a > b).alias("right")))
        proof = F.when(F.col("n") == 1, F.col("proof")).otherwise(F.concat(own, F.col("proof")))
        return kid.withField("proof", proof)

    return F.transform("kids", step)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and the steps of its proof."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    docs: DataFrame,
    group: str = "source",
    order: str = "doc_id",
    columns: Sequence[str] = LEAF_COLUMNS,
    changed: dict[str, Column] | None = None,
    changed_where: Column | bool = True,
) -> DataFrame:
    """One row per row of `docs`: `order` and `group` columns, leaf, subroot, root, proof, and `probed`.

    A leaf digests the `columns` of its row. The leaves of a group (null is a group of its own, the first) in the
    order of `order` (null first) make a tree with runs of sixteen; the tops of all groups, by name, make one more.
    `proof` is the list of (left, right) siblings up to the root. `probed` is the leaf of a row with `changed` columns,
    where `changed_where` holds, else null: folded with the proof it gives the root only if nothing really changed. Rows with equal order are placed by their
    leaf; equal rows are leaves of their own, with the proofs of neighbouring places. An empty table gives no rows. A
    long text is only digested, in one piece; other columns of `docs` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    size = int(spark.conf.get("spark.sql.shuffle.partitions"))
    where = changed_where if isinstance(changed_where, Column) else F.lit(changed_where)
    probed = F.when(where, leaf_digest(columns, changed)) if changed else F.lit(None).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-")).alias("group"),
        F.col(f"`{order}`").alias("id"),
        leaf_digest(columns).alias("digest"),
        probed.alias("probed"),
    )
    leaves = placed(leaves, ["group"], ["id", "digest"], ("place", "n"))
    levels, tops = forward(leaves, size, "leaves")
    tops = staged(tops, "tops")
    high = tops.select(F.lit(0).alias("group"), "digest", F.col("group").alias("name"))
    high = placed(high, ["group"], ["name"], ("place", "n"))
    high_levels, high_top = forward(high, size, "tops")
    top = high_top.first()  # of the whole table
    above = high_top.select("group", F.array().cast("array<struct<left:string,right:string>>").alias("proof"))
    named = backward(high_levels, above, "tops").select(F.explode(with_steps()).alias("kid"))
    rest = named.select(
        F.col("kid.name").alias("group"), F.col("kid.proof").alias("proof"), F.col("kid.digest").alias("subroot")
    )
    runs = backward(levels, staged(rest, "rest"), "leaves")
    rows = runs.select("group", "subroot", F.explode(with_steps()).alias("kid"))
    return rows.select(
        F.col("kid.id").alias(order),
        F.when(F.col("group") != "-", F.substring("group", 2, 2**31 - 1)).alias(group),
        F.col("kid.digest").alias("leaf"),
        "subroot",
        F.lit(top["digest"] if top else None).cast("string").alias("root"),
        F.col("kid.proof").alias("proof"),
        F.col("kid.probed").alias("probed"),
    )
