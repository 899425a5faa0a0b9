"""Evaluation of region detection against labelled cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.operators.shape import compute_once

# Words of a case's name that put it into a bucket, in order.
BUCKETS = [
    ("Africa", ["Africa"]),
    ("Latin America", ["Latin America", "Brazil", "Mexico"]),
    ("MENA", ["MENA", "Saudi", "UAE"]),
    ("Multi-continent", ["Global", "International"]),
]
OTHER_BUCKET = "Edge cases"


def tag_diff(df: DataFrame, expected: str = "expected", detected: str = "detected") -> DataFrame:
    """Adds what was missed and what was found beyond the expectation, both sorted."""
    return df.withColumns(
        {
            "missing": F.array_sort(F.array_except(expected, detected)),
            "false_positives": F.array_sort(F.array_except(detected, expected)),
        }
    )


def tag_pass(df: DataFrame) -> DataFrame:
    """A case passes if nothing expected is missing; false positives do not fail it."""
    return df.withColumn("status", F.when(F.size("missing") == 0, "PASSED").otherwise("FAILED"))


def evaluate(cases: DataFrame, detected: Column) -> DataFrame:
    return tag_pass(tag_diff(compute_once(cases, detected=detected)))


def bucket(name: Column) -> Column:
    chosen = None
    for label, words in BUCKETS:
        test = F.lit(False)
        for word in words:
            test = test | name.contains(word)
        chosen = F.when(test, label) if chosen is None else chosen.when(test, label)
    return chosen.otherwise(OTHER_BUCKET)


def region_accuracy(results: DataFrame) -> DataFrame:
    """Passed, failed and all cases per bucket of case names."""
    return results.groupBy(bucket(F.col("name")).alias("bucket")).agg(
        F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count("*").alias("total"),
    )


def failure_patterns(results: DataFrame) -> DataFrame:
    """How often each set was missed, or wrongly found, among failed cases."""
    failed = results.where(F.col("status") == "FAILED")
    kinds = F.array(
        F.struct(F.lit("missing").alias("kind"), F.array_join("missing", ", ").alias("regions")),
        F.struct(F.lit("false_positive").alias("kind"), F.array_join("false_positives", ", ").alias("regions")),
    )
    return (
        failed.select(F.explode_outer(kinds).alias("pattern"))
        .select("pattern.*")
        .where(F.col("regions") != "")
        .groupBy("kind", "regions")
        .agg(F.count("*").alias("cases"))
    )
