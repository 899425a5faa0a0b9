"""Exact and near duplicates against brute force, and their odd rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import bagminhash, exact_dedup
from presslake.llm.components import components

SCHEMA = "doc_id long, text string, kept string, lang string"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)


def test_exact_classes_equal_grouping(spark):
    texts = ["", None, "a", "a", "ab" * 40, "ab" * 40 + "c", "ab" * 39, "é" * 33, "é" * 33, "é" * 34, "a", "x" * 5000, "x" * 5000, "y" + "x" * 4999]
    df = rows_of(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r for r in exact_dedup.exact_classes(df, block_chars=8).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["_kept"]) == (max(same), len(same), i == max(same))
        assert got[i]["kept"] == "x"


def test_exact_names_do_not_need_hashes(spark):
    rows = spark.createDataFrame([(1, "abcabc"), (2, "abcabd"), (3, "abc"), (4, "abcabc"), (5, ""), (6, ""), (7, "a" * 100)], "rid long, body string")
    names = {r["rid"]: (r["n_blocks"], r["name"]) for r in exact_dedup.block_names(rows, 3).collect()}
    assert names[1] == names[4] and names[5] == names[6]
    assert len(set(names.values())) == 5


def test_exact_ties_nulls_and_empty(spark):
    df = rows_of(spark, [(7, "t"), (7, "t"), (None, "t"), (None, "u"), (None, "u")])
    rows = exact_dedup.exact_classes(df).collect()
    assert sum(r["_kept"] for r in rows if r["text"] == "t") == 1
    assert {r["keep_id"] for r in rows if r["text"] == "t"} == {7}
    assert sum(r["_kept"] for r in rows if r["text"] == "u") == 1
    assert exact_dedup.exact_classes(rows_of(spark, [])).count() == 0


def shingles(text, size=5):
    words = bagminhash_words(text)
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def bagminhash_words(text):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def brute_classes(docs, threshold=0.8):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    texts = dict(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if texts[a] == texts[b] or similarity(sets[a], sets[b]) >= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_rows(df):
    return {r["doc_id"]: r for r in bagminhash.near_classes(df).collect()}


def test_near_classes_equal_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_classes(docs)
    got = near_rows(rows_of(spark, docs))
    assert {i: r["class_id"] for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[want[i]] and r["_kept"] == (want[i] == i) for i, r in got.items())


def test_a_crowd_of_edited_copies(spark):
    """A group whose members are edited more or less: linked ones are one class, the others stay alone."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(i % 8):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    want = brute_classes(docs)
    assert len(set(want.values())) > 20
    assert {i: r["class_id"] for i, r in near_rows(rows_of(spark, docs)).items()} == want


def test_near_odd_rows(spark):
    long_text = " ".join(f"word{i % 997}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, "?!"), (4, "one two"), (5, "One, two!"), (6, long_text), (7, long_text + " end"), (8, "a a a a a a a a"), (9, "a a a a a")]
    got = near_rows(rows_of(spark, docs))
    assert {i: r["class_id"] for i, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 9}
    tied = bagminhash.near_classes(rows_of(spark, [(3, "p q r s t u"), (3, "p q r s t u"), (None, "p q r s t u"), (None, "z"), (None, "z")])).collect()
    assert sum(r["_kept"] for r in tied if r["class_id"] == 3) == 1
    assert sum(r["_kept"] for r in tied if r["class_id"] is None) == 1
    assert bagminhash.near_classes(rows_of(spark, [])).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(20):
        base = rng.integers(0, 2**63, size=150).astype("u8")
        a = rng.integers(0, 9, size=150)
        b = np.where(rng.random(150) < 0.6, a, rng.integers(0, 9, size=150))
        both = np.concatenate([np.repeat(base, a), np.repeat(base, b)])
        text = np.repeat([0, 1], [a.sum(), b.sum()])
        registers = bagminhash.signatures(*bagminhash.multisets(both, text), 2, 1024)
        errors.append((registers[0] == registers[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.03


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] if seed == 1 else [(i, i + 1) for i in range(40)]
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    frame = lambda part: spark.createDataFrame(part, "a long, b long")
    got = components(frame(links[20:]), components(frame(links[:20])))
    assert {r["node"]: r["root"] for r in got.collect()} == {v: find(v) for a, b in links for v in (a, b) if a != b}
    assert components(frame([])).count() == 0
