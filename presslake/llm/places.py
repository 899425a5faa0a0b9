"""Places of rows within their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import fresh, staged


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str], names: tuple[str, str] = ("place", "group_size")) -> DataFrame:
    """Adds each row's place in its group (from 0, by `order`, nulls first) and the group's size.

    Rows are dealt by range of group and order, so a group with most of the rows lies in many
    parts, and are counted within their part. A group that reaches over several parts adds what
    its earlier parts hold: at most two such groups per part, which bounds the table of
    offsets by the number of parts. Rows that tie in all of `order` are told apart
    by a number given to them beforehand. `df` is read once.
    """
    row, part, here, before, total = fresh(df, "row", "part", "here", "before", "total")
    place, size = names
    numbered = staged(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    keys = [F.col(f"`{c}`") for c in (*group, *order, row)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartitionByRange(parts, *keys).withColumn(part, F.spark_partition_id())
    dealt = staged(dealt, "dealt")
    counts = dealt.groupBy(part, *group).agg(F.count(F.lit(1)).alias(here))
    same = Window.partitionBy(*group)
    reach = counts.withColumns(
        {
            before: F.coalesce(F.sum(here).over(same.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            total: F.sum(here).over(same),
        }
    ).filter(F.col(total) > F.col(here))
    offsets = reach.select(part, *(F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(group)), before, total)
    within = Window.partitionBy(part, *group)
    ranked = dealt.withColumns(
        {place: F.row_number().over(within.orderBy(*keys[len(group):])) - 1, here: F.count(F.lit(1)).over(within)}
    )
    meets = ranked[part] == offsets[part]
    for i, c in enumerate(group):
        meets = meets & ranked[c].eqNullSafe(offsets[f"g{i}"])
    # At most two rows per part.
    out = ranked.join(F.broadcast(offsets), meets, "left")
    return out.select(
        *(ranked[c] for c in df.columns),
        (F.col(place) + F.coalesce(F.col(before), F.lit(0))).cast("long").alias(place),
        F.coalesce(F.col(total), F.col(here)).alias(size),
    )
