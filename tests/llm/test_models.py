"""Toxicity, decontamination and quality against brute force and held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import decontam, kneser_ney, toxicity
from presslake.llm.queries import TOXICITY_CHAIN

MEDIUM = "/root/testdata/sf0.1"


def labelled(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def test_toxicity_of_rows_that_were_not_labelled_for_it(spark):
    """Fitted on half of the labels; the other half shows what it does to new rows."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").repartition(8)
    labels = labelled(spark, MEDIUM)
    half = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 0
    chain = toxicity.fit_chain(docs, labels.filter(half), TOXICITY_CHAIN)
    judged = toxicity.judge(docs.join(labels.filter(~half).withColumnRenamed("toxic", "y"), "doc_id"), chain, lambda c: c == "toxic")
    count = Counter((r["y"], r["kept"]) for r in judged.select("y", "kept").collect())
    assert count[0, False] <= 0.003 * (count[0, True] + count[0, False])
    assert count[1, False] >= 0.7 * (count[1, True] + count[1, False])


def test_later_categories_see_earlier_ones():
    rng = np.random.default_rng(1)
    n = 600
    first = rng.integers(0, 2, n)
    tokens = [[1] if y else [2] for y in first]
    flat, cuts = np.array([t for x in tokens for t in x], "i4"), np.arange(n + 1)
    model = toxicity.fit_linear(flat, cuts, np.zeros((n, 0)), first.astype("f8"))
    p = model.score(flat, cuts, np.zeros((n, 0)))
    assert ((p > 0.5) == (first == 1)).all()
    # The second category is the first one; its own tokens say nothing.
    blank = np.full(n, 3, "i4")
    second = toxicity.fit_linear(blank, cuts, p[:, None], first.astype("f8"))
    assert second.earlier[0] > 1
    assert ((second.score(blank, cuts, p[:, None]) > 0.5) == (first == 1)).all()


def test_lookup_tables_belong_to_their_chain():
    empty = toxicity.Linear(np.zeros(0, "i8"), np.zeros(0), np.zeros(0), 0.0)
    for n in (1, 2, 1):
        assert len(toxicity._tables(toxicity.Chain(["c"] * n, [empty] * n, [2.0] * n))) == n


def test_threshold_keeps_its_precision():
    scores = np.array([0.9, 0.8, 0.8, 0.7, 0.2])
    assert toxicity.threshold_of(scores, np.array([1, 1, 1, 0, 1]), 1.0) == pytest.approx(0.75)
    assert toxicity.threshold_of(scores, np.array([0, 1, 0, 0, 0]), 0.9) == 2.0
    assert toxicity.threshold_of(scores[:0], scores[:0], 0.9) == 2.0


def test_toxicity_of_odd_rows(spark):
    text = "fine words " * 3
    docs = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, text, "k"), (3, text, "k"), (None, text * 3000, None)], "doc_id long, text string, kept string")
    no_labels = spark.createDataFrame([], "doc_id long, bad int")
    one_class = spark.createDataFrame([(1, 0), (3, 0), (None, 1), (2, None)], "doc_id long, bad int")
    for labels in (no_labels, one_class):
        chain = toxicity.fit_chain(docs, labels, ["bad"])
        rows = toxicity.judge(docs, chain).collect()
        assert len(rows) == 5 and all(r["_kept"] and not r["bad"] for r in rows)
        assert toxicity.judge(docs.limit(0), chain).count() == 0
    assert toxicity.fit_chain(docs.limit(0), one_class, ["bad"]).thresholds == [2.0]


def words(text):
    return decontam.words_in((text or "").lower())


def test_leaks_of_the_supplied_tables(spark, sf):
    """Every verbatim item is found, and no other document is touched."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").repartition(8)
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, items).collect()}
    shown = [(i, f" {' '.join(words(t))} ") for i, t in items.collect()]
    want = {(d, i) for d, t in docs.collect() for line in [f" {' '.join(words(t))} "] for i, x in shown if x in line}
    assert len(want) > 200 and got == want


def test_paraphrases_are_found(spark):
    """Items with a sixth of their words replaced, in other text of the same words: recall of at least 0.9."""
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(5000)]
    shares = [1 / (k + 2) for k in range(5000)]
    text = lambda n: rng.choices(vocabulary, shares, k=n)
    items = [text(rng.randrange(15, 55)) for _ in range(60)]
    docs, want = [], set()
    for d in range(400):
        body = text(rng.randrange(30, 600))
        if d % 4 == 0:
            i = d // 4 % 60
            item = list(items[i])
            for _ in range(len(item) // 6):  # a paraphrase: words replaced, the answer kept
                item[rng.randrange(max(1, len(item) - 6))] = rng.choice(vocabulary)
            at = rng.randrange(len(body))
            body[at:at] = item
            want.add((d, i))
        docs.append((d, " ".join(body)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(frame, bench).collect()}
    assert len(got & want) >= 0.9 * len(want)
    assert len(got - want) <= 0.05 * len(want)


def test_space_is_fitted_on_all_different_texts(spark):
    """The same product of all strides, whole in numpy, spans the same space; copies of a text count once."""
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(60)]
    bodies = [" ".join(rng.choices(vocabulary, [1 / (k + 4) for k in range(60)], k=rng.choice([3, 20, 70]))) for _ in range(3000)]
    docs = spark.createDataFrame([(d, b) for d, b in enumerate([*bodies, *bodies[:900], "", ""])], "doc_id long, body string")
    asked = [rng.sample(vocabulary, 12) for _ in range(9)]
    items = decontam.Items(list(range(9)), asked, asked)
    texts = decontam.different_texts(decontam.item_words(docs.repartition(5), items))
    n_docs, df = decontam.document_counts(texts, items.n_terms)
    different = sorted({*bodies, ""})
    assert n_docs == len(different) > 2500
    assert df.tolist() == [sum(w in b.split() for b in different) for w in sorted(items.terms, key=items.terms.get)]
    space = decontam.fit_space(texts, items, n_docs, df, rank=6)

    strides = [b.split()[i : i + decontam.STRIDE] for b in different for i in range(0, len(b.split()), decontam.STRIDE)]
    rows = np.zeros((len(strides), items.n_terms))
    for row, own in zip(rows, strides, strict=True):
        for w in own:
            if w in items.terms:
                row[items.terms[w]] += 1
    weigh = lambda counts: (x := np.log1p(counts) * space.idf) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    rows = weigh(rows)
    own = weigh(np.array([[w in item for w in sorted(items.terms, key=items.terms.get)] for item in asked], float))
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((items.n_terms, 6)))[0]
    for _ in range(decontam.POWER_STEPS):
        basis = np.linalg.qr(rows.T @ (rows @ basis) + len(rows) / len(own) * (own.T @ (own @ basis)))[0]
    assert np.abs(basis @ basis.T - space.basis.astype("f8") @ space.basis.T).max() < 1e-3


def test_items_in_blocks_find_the_same(spark):
    bench = spark.createDataFrame([(i, " ".join(f"b{i}x{k}" for k in range(20))) for i in range(7)] + [(9, ""), (10, None)], "item_id long, text string")
    docs = spark.createDataFrame([(d, "some words " * 30 + " ".join(f"b{d % 7}x{k}" for k in range(20)) + " end") for d in range(20)] + [(50, None), (51, "")], "doc_id long, text string")
    whole = {(r[0], r[1]) for r in decontam.find_leaks(docs, bench).select("doc_id", "item_id").collect()}
    parts = {(r[0], r[1]) for r in decontam.find_leaks(docs, bench, block_items=3, rank=4).select("doc_id", "item_id").collect()}
    assert whole == parts == {(d, d % 7) for d in range(20)}
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.lcs_length(a, b) == table[-1][-1]


def test_answers():
    assert decontam.answer_words("What is it? It is a very large tree.") == ["it", "is", "a", "very", "large", "tree"]
    assert decontam.answer_words("One two three. Yes.") == ["one", "two", "three", "yes"]
    assert decontam.answer_words("...") == []


def chances(counted, scored):
    """Perplexities under a dictionary form of the model."""
    ident = lambda t: [0] + [1 + zlib.crc32(x.encode()) % ((1 << 20) - 1) for x in kneser_ney._find(t or "")]
    pairs = Counter(p for t in counted for ids in [ident(t)] for p in zip(ids, ids[1:], strict=False))
    total, follows, by = Counter(), Counter(), defaultdict(lambda: [0] * 4)
    for (v, w), n in pairs.items():
        total[v] += n
        follows[w] += 1
        by[v][min(n, 3)] += 1
    cut = kneser_ney._discounts(np.bincount(list(pairs.values()), minlength=5)[1:5])
    low = kneser_ney._discounts(np.bincount(list(follows.values()), minlength=5)[1:5])
    kinds = sum(follows.values())
    rest = sum(min(low[min(n, 3)], n) for n in follows.values()) / kinds / (1 << 20)
    lower = lambda w: max(follows[w] - low[min(follows[w], 3)], 0) / kinds + rest
    out = []
    for t in scored:
        ids, log = ident(t), 0.0
        for v, w in zip(ids, ids[1:], strict=False):
            p = lower(w)
            if total[v]:
                n = pairs[v, w]
                p = max(n - cut[min(n, 3)], 0) / total[v] + sum(cut[k] * by[v][k] for k in (1, 2, 3)) / total[v] * p
            log += math.log(p)
        out.append(math.exp(-log / (len(ids) - 1)) if len(ids) > 1 else None)
    return out


def test_words_are_cut_bytewise_as_by_the_pattern():
    chars = map(chr, [*range(0xD800), *range(0xE000, 0x11000)])
    for text in ["", "Don't_stop—now… Ärger ÉÀ\u00a0x\u3000漢字 a\u0301 ½ İI ①", *("a" + c + "b_1 " + c for c in chars)]:
        assert [w.decode() for w in decontam.word_bytes(text)] == decontam.words_in(text.lower())


def test_sums_of_runs():
    rng = np.random.default_rng(1)
    rows, picked = rng.standard_normal((50, 7)).astype("f4"), rng.integers(0, 50, 200)
    starts = np.array([0, 1, 5, 40, 41, 199])
    want = np.add.reduceat(rows[picked], starts, axis=0)
    assert np.allclose(decontam._run_sums(rows, picked, starts), want, atol=1e-5)


def test_perplexity_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in rows] + [(9001, None, "en"), (9002, "", None), (9003, " \n", "en"), (9004, "the the " * 40_000, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4, "doc_id")
    trusted = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id")
    held = {r[0] for r in trusted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(kneser_ney.HELD_OUT)) == 0).collect()}
    good = {r[0] for r in trusted.collect()}
    got = {r["doc_id"]: r for r in kneser_ney.judge_quality(docs, trusted).collect()}
    want = chances([t for d, t, _ in rows if d in good - held], [t for _, t, _ in rows])
    for (d, _, _), p in zip(rows, want, strict=True):
        assert got[d]["perplexity"] == (None if p is None else pytest.approx(p, rel=1e-4)), d
    assert not any(got[d]["kept"] for d in (9001, 9002, 9003)) and got[9001]["n_tokens"] == 0
    # All but the quantile of the trusted rows that were not counted are kept.
    assert all(got[d]["kept"] for d in held)


def test_quality_keeps_good_rows_and_drops_bad_ones(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    trusted = labels.filter("quality = 1 and pmod(doc_id, 3) > 0")
    judged = kneser_ney.judge_quality(docs, trusted).join(labels, "doc_id").filter("quality = 0 or pmod(doc_id, 3) = 0")
    count = Counter((r["quality"], r["kept"]) for r in judged.collect())
    assert count[1, False] <= 0.01 * (count[1, True] + count[1, False])
    assert count[0, False] >= 0.6 * (count[0, True] + count[0, False])


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, "c", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    rows = kneser_ney.judge_quality(docs, none).collect()
    assert len(rows) == 4 and [r["kept"] for r in rows if r["n_tokens"]] == [True] * 3
    assert kneser_ney.judge_quality(docs.limit(0), none).count() == 0
    assert kneser_ney.judge_quality(docs, spark.createDataFrame([(1,), (None,)], "doc_id long")).count() == 4
