"""Toxicity categories by a chain of linear classifiers.

The categories are predicted one after the other: the model of a category sees the
text's tokens and the probabilities of all earlier categories. A later model is
trained on out-of-fold probabilities of the earlier ones (each row scored by a
model that has not seen it), so in training it sees inputs as uncertain as later on.

The chain is fitted on at most `max_rows` labelled rows, those with the smallest hash
of their id; texts become token ids in the JVM, a fit keeps the few thousand tokens
whose frequencies differ most between the classes of its training folds. Scoring is a
table lookup per token and runs over every row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import fresh, whole_text, words_of

TOKEN_BITS = 20
MAX_ROWS = 12_000
MAX_TOKENS = 2_000
FOLDS = 3
#: Least precision, out of fold, at which a row is rejected.
PRECISION = 0.995


def token_ids(text: Column) -> Column:
    """Ids of a text's distinct words, of the first three to five letters of longer words, and of its shape."""
    # One expression over the words: Spark would work out a repeated one again.
    with_starts = F.transform(
        F.array_distinct(words_of(text)),
        lambda w: F.when(
            F.length(w) > 5, F.array(w, *[F.concat(F.substring(w, 1, k), F.lit("*")) for k in (3, 4, 5)])
        ).otherwise(F.array(w)),
    )
    tokens = F.array_distinct(F.flatten(with_starts))
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda kept: F.floor(F.lit(20) * F.length(F.regexp_replace(text, kept, "")) / size).cast("string")
    shape = F.array(
        F.concat(F.lit("=upper "), share(r"[^\p{Lu}]+")),
        F.concat(F.lit("=marks "), share(r"[\p{L}\p{N}\s]+")),
        F.concat(F.lit("=size "), F.floor(F.log2(size)).cast("string")),
    )
    return F.transform(F.concat(tokens, shape), lambda t: F.pmod(F.xxhash64(t), F.lit(1 << TOKEN_BITS)).cast("int"))


@dataclass
class Linear:
    """Weights of token ids, of earlier probabilities, and a bias."""

    ids: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def score(self, tokens: np.ndarray, cuts: np.ndarray, before: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """Probability of each row; `cuts` are the rows' offsets into `tokens`."""
        if table is None:
            table = self.table()
        sums = np.zeros(len(tokens) + 1)
        np.cumsum(table[tokens], dtype="f8", out=sums[1:])
        margin = sums[cuts[1:]] - sums[cuts[:-1]] + before @ self.earlier + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def table(self) -> np.ndarray:
        table = np.zeros(1 << TOKEN_BITS, "f4")
        table[self.ids] = self.weights
        return table


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]
    thresholds: list[float]


def _class_counts(tokens: np.ndarray, row: np.ndarray, weight: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Summed row weights of each token, a part of the tokens at a time."""
    out = np.zeros(1 << TOKEN_BITS)
    for low in range(0, len(tokens), step):
        out += np.bincount(tokens[low : low + step], weights=weight[row[low : low + step]], minlength=len(out))
    return out


def fit_linear(
    tokens: np.ndarray,
    cuts: np.ndarray,
    before: np.ndarray,
    y: np.ndarray,
    train: np.ndarray | None = None,
    max_tokens: int = MAX_TOKENS,
    ridge: float = 1.0,
    steps: int = 200,
) -> Linear:
    """Logistic regression over the tokens that tell the classes apart best, on the rows of `train` (all if not given).

    With rows of one class only, the result is a constant.
    """
    train = np.ones(len(y), bool) if train is None else train
    n, hit = float(train.sum()), float(y[train].sum())
    prior = float(np.log((hit + 0.5) / (n - hit + 0.5)))
    none = Linear(np.zeros(0, "i8"), np.zeros(0), np.zeros(before.shape[1]), prior)
    if hit in (0.0, n):
        return none
    row = np.repeat(np.arange(len(y), dtype="i4"), np.diff(cuts))
    with_hit = _class_counts(tokens, row, (y * train).astype("f4"))
    a, b = with_hit + 0.5, _class_counts(tokens, row, train.astype("f4")) - with_hit + 0.5
    z = np.abs(np.log(a / (hit + 1)) - np.log(b / (n - hit + 1))) / np.sqrt(1 / a + 1 / b)
    chosen = np.sort(np.argsort(-z, kind="stable")[:max_tokens])
    chosen = chosen[z[chosen] > 3]
    place = np.full(1 << TOKEN_BITS, -1, "i4")
    place[chosen] = np.arange(len(chosen))
    col = place[tokens]
    use = (col >= 0) & train[row]
    row, col = row[use], col[use]
    # Accelerated gradient with a step for each weight from its count.
    m = len(chosen)
    scale = np.concatenate([ridge + 0.25 * np.bincount(col, minlength=m), np.full(before.shape[1] + 1, ridge + 0.25 * n)])
    wide = np.concatenate([before, np.ones((len(y), 1))], axis=1)
    w = v = np.concatenate([np.zeros(m + before.shape[1]), [prior]])
    degree = max(1.0, len(row) / n + wide.shape[1])
    for t in range(1, steps + 1):
        margin = np.bincount(row, weights=v[col], minlength=len(y)) + wide @ v[m:]
        off = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * train
        grad = np.concatenate([np.bincount(col, weights=off[row], minlength=m), wide.T @ off]) + ridge * v
        new = v - grad / scale / degree**0.5
        v = new + (t - 1) / (t + 2) * (new - w)
        w = new
    return Linear(chosen, w[:m], w[m:-1], float(w[-1]))


def threshold_of(scores: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest cut at which the rows above it reach the precision; above 1 if there is none."""
    if not len(y) or not y.any():
        return 2.0
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(y[order])
    last_of_tie = np.append(s[1:] != s[:-1], True)
    good = last_of_tie & (hits / np.arange(1, len(s) + 1) >= precision)
    if not good.any():
        return 2.0
    at = np.flatnonzero(good)[-1]
    # Half way to the next score, so that equal evidence in other rows falls on the same side.
    return float((s[at] + s[at + 1]) / 2) if at + 1 < len(s) else float(s[at])


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    text_col: str = "text",
    id_col: str = "doc_id",
    max_rows: int = MAX_ROWS,
    folds: int = FOLDS,
    precision: float = PRECISION,
) -> Chain:
    """Fit the chain on labelled rows: `labels` has the id and a 0/1 column per category, in chain order.

    Rows without an id, or with a null in a category, are no labels; of repeated ids one
    row counts. Without labelled rows, or with one class only, a category gets
    a constant probability and rejects nothing.
    """
    chosen = (
        labels.select(F.col(id_col).alias("label_id"), *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(categories)])
        .dropna()
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_rows)
        .dropDuplicates(["label_id"])
    )
    # At most max_rows narrow rows: the bound that allows the broadcast and the collecting.
    table = (
        docs.select(F.col(f"`{id_col}`").alias("doc"), whole_text(text_col).alias("body"))
        .join(F.broadcast(chosen), F.col("doc") == F.col("label_id"))
        .dropDuplicates(["label_id"])
        .select("label_id", token_ids(F.col("body")).alias("tokens"), F.array(*[f"y{i}" for i in range(len(categories))]).alias("y"))
        .toArrow()
        .sort_by("label_id")
    )
    n = table.num_rows
    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(table.column("tokens")).to_numpy())]).astype("i8")
    tokens = np.concatenate([np.asarray(c.flatten()) for c in table.column("tokens").chunks] or [np.zeros(0, "i4")]).astype("i4")
    ys = np.array(table.column("y").to_pylist(), "f8").reshape(n, len(categories))
    del table
    pa.default_memory_pool().release_unused()
    fold = np.arange(n) % folds
    before = np.zeros((n, 0))
    models, thresholds = [], []
    for i in range(len(categories)):
        y = ys[:, i]
        held_out = np.zeros(n)
        for k in range(folds):
            test = fold == k
            if test.all() or not test.any():
                continue
            part = fit_linear(tokens, cuts, before, y, ~test)
            held_out[test] = part.score(tokens, cuts, before)[test]
        models.append(fit_linear(tokens, cuts, before, y))
        thresholds.append(threshold_of(held_out, y, precision))
        before = np.concatenate([before, held_out[:, None]], axis=1)
    return Chain(list(categories), models, thresholds)


def probabilities(text: Column, chain: Chain) -> Column:
    """Probabilities of the categories, in chain order."""

    @F.arrow_udf("array<double>")
    def scored(lists: pa.Array) -> pa.Array:
        tables = _tables(chain)
        cuts = np.asarray(lists.offsets).astype("i8")
        tokens = np.asarray(lists.flatten())
        cuts -= cuts[0]
        before = np.zeros((len(lists), 0))
        for model, table in zip(chain.models, tables, strict=True):
            before = np.concatenate([before, model.score(tokens, cuts, before, table)[:, None]], axis=1)
        width = before.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1) * width, pa.int32()), pa.array(before.reshape(-1)))

    return scored(token_ids(text))


_TABLES: dict[tuple, list[np.ndarray]] = {}


def _tables(chain: Chain) -> list[np.ndarray]:
    """Lookup tables of a chain, built once in a worker."""
    key = tuple((m.ids.tobytes(), m.weights.tobytes()) for m in chain.models)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = [m.table() for m in chain.models]
    return _TABLES[key]


def judge(df: DataFrame, chain: Chain, rejecting: Callable[[str], bool] = lambda _: True, text_col: str = "text") -> DataFrame:
    """Every row of `df` with added columns p_<category> and <category>, and kept.

    Added names that clash with a column of `df` get an underscore in front. A category is
    set when its probability reaches the chain's threshold; a row is not kept when a category
    for which `rejecting` holds is set. Null and empty texts have no tokens but
    their shape and are judged like any other; an empty table gives an empty table.
    """
    scores, kept = fresh(df, "scores", "kept")
    out = df.withColumn(scores, probabilities(whole_text(text_col), chain))
    hits = []
    for i, (category, cut) in enumerate(zip(chain.categories, chain.thresholds, strict=True)):
        p, flag = fresh(out, f"p_{category}", category)
        out = out.withColumn(p, F.col(scores)[i]).withColumn(flag, F.col(scores)[i] >= cut)
        if rejecting(category):
            hits.append(F.col(flag))
    rejected = F.lit(False)
    for hit in hits:
        rejected = rejected | hit
    return out.withColumn(kept, ~rejected).drop(scores)
