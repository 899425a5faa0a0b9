"""Quality scores of articles: a fixed formula, a model fitted on labelled ones, and how well a score ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions import lexicons as lex
from presslake.functions.match import WHOLE_WORD, TermScanner
from presslake.operators.shape import compute_once
from presslake.session import scratch_dir

FEATURES = (
    "log_chars", "word_chars", "sentence_words", "distinct_share", "line_share", "digit_share", "mark_share", "upper_share", "keywords",
)
#: Points of the formula: what an article gains by being long, varied and in sentences, and loses by marks and digits.
WEIGHTS = {"log_chars": 0.1, "distinct_share": 0.3, "digit_share": -2.0, "mark_share": -1.0, "keywords": 0.05}
#: Slices of the scores that ranks are counted in.
SLICES = 1024


def features(df: DataFrame, text: str, keywords: Sequence[str] = lex.NEWS_KEYWORDS) -> DataFrame:
    """Adds FEATURES of the text, all numbers; null counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.char_length(body), F.lit(1))
    words = F.regexp_extract_all(F.lower(body), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    lines = F.filter(F.split(body, "\n"), lambda line: line != "")
    hits = TermScanner({k.lower(): WHOLE_WORD for k in keywords}).hits(F.lower(body))
    read = compute_once(df, q_words=words, q_lines=lines, q_hits=F.size(F.array_distinct(hits)))
    n_words = F.greatest(F.size("q_words"), F.lit(1))
    share = lambda pattern: F.regexp_count(body, F.lit(pattern)) / chars
    values = {
        "log_chars": F.log1p(F.char_length(body).cast("double")),
        "word_chars": F.char_length(F.array_join("q_words", "")) / n_words,
        "sentence_words": n_words / F.greatest(F.regexp_count(body, F.lit(r"[.!?](?:\s|$)")), F.lit(1)),
        "distinct_share": F.size(F.array_distinct("q_words")) / n_words,
        "line_share": F.size(F.array_distinct("q_lines")) / F.greatest(F.size("q_lines"), F.lit(1)),
        "digit_share": share(r"\p{N}"),
        "mark_share": share(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"),
        "upper_share": share(r"\p{Lu}"),
        "keywords": F.col("q_hits"),
    }
    columns = {name: F.round(value.cast("double"), 9) for name, value in values.items()}
    return compute_once(read, **columns).drop("q_words", "q_lines", "q_hits")


def stage_features(rows: DataFrame, *columns: str) -> DataFrame:
    """The features and the named columns of `rows`, computed once into the shared scratch folder: fitting reads them several times."""
    staged = scratch_dir(rows.sparkSession, "features")
    slim = rows.select(*columns, *FEATURES)
    slim.write.parquet(staged)
    return rows.sparkSession.read.schema(slim.schema).parquet(staged)


def formula_score(weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted sum of features, to six places."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    return F.round(total, 6)


def fit_quality(labelled: DataFrame, label: str = "quality") -> PipelineModel:
    """A logistic model of FEATURES, fitted on all rows with a label; it reads them several times, so they should be staged."""
    rows = labelled.where(F.col(label).isNotNull()).select(*FEATURES, F.col(label).cast("double").alias("label"))
    stages = [
        VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=100, regParam=0.001),
    ]
    return Pipeline(stages=stages).fit(rows)


def model_score(df: DataFrame, model: PipelineModel, into: str = "score") -> DataFrame:
    """Adds the model's probability of good quality."""
    scored = model.transform(df).withColumn(into, F.round(vector_to_array("probability")[1], 9))
    return scored.select(*df.columns, into)


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row: positives, negatives and the chance that a positive scores higher than a negative (ties count half).

    Rows are counted per score first. Scores are then ranked within slices of their range, and the slices among each
    other, so no task sorts all of them. Null scores and labels are left out; `auc` is null without rows of both kinds.
    """
    rows = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("l")).where("s IS NOT NULL AND l IS NOT NULL")
    counted = rows.groupBy("s").agg(F.count_if(F.col("l") == 1).alias("p"), F.count_if(F.col("l") != 1).alias("n"))
    # Scores are counted once: their texts would be read again for the range, the slices and the ranks.
    staged = scratch_dir(scored.sparkSession, "scores")
    counted.write.parquet(staged)
    counted = scored.sparkSession.read.schema(counted.schema).parquet(staged)
    span = counted.agg(F.min("s").alias("low"), F.max("s").alias("high")).first()
    low, width = span["low"] or 0.0, ((span["high"] or 0.0) - (span["low"] or 0.0)) or 1.0
    sliced = counted.withColumn("slice", F.floor((F.col("s") - low) / width * (SLICES - 1)))
    # One row per slice.
    slices = sliced.groupBy("slice").agg(F.sum("n").alias("slice_n"))
    before = F.sum("slice_n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select("slice", F.coalesce(before, F.lit(0)).alias("slices_below"))
    within = F.sum("n").over(Window.partitionBy("slice").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    ranked = sliced.withColumn("below", F.coalesce(within, F.lit(0))).join(F.broadcast(slices), "slice")
    wins = F.col("p") * (F.col("slices_below") + F.col("below") + F.col("n") / 2)
    totals = ranked.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"), F.sum(wins).alias("wins"))
    both = F.col("positives") * F.col("negatives")
    chance = F.when(both > 0, F.round(F.col("wins") / both, 6)).alias("auc")
    return totals.select(F.coalesce("positives", F.lit(0)).alias("positives"), F.coalesce("negatives", F.lit(0)).alias("negatives"), chance)
