"""Merkle manifest, chat formatting and whitening against brute force."""

import sys
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F

from presslake.catalog.check import _rows, connect
from presslake.llm import chat, merkle, whitening
from presslake.llm.places import placed
from presslake.llm.queries import QUERIES, SQL

# The templates below go to the workers, which cannot import this module.
register_pickle_by_value(sys.modules[__name__])

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------------------
# Places
# ---------------------------------------------------------------------------
def test_places_of_a_hot_group(spark):
    rows = [("a", i * 7919 % 1000) for i in range(1000)] + [(None, 5), (None, None), ("b", 1)] + [("t", 1)] * 50
    got = placed(spark.createDataFrame(rows, "place string, n int"), ["place"], ["n"], ("at", "size")).collect()
    for key in ("a", None, "b", "t"):
        mine = sorted((r["at"], -1 if r["n"] is None else r["n"]) for r in got if r["place"] == key)
        want = sorted(-1 if n is None else n for k, n in rows if k == key)
        assert [n for _, n in mine] == want
        assert [at for at, _ in mine] == list(range(len(want)))
        assert {r["size"] for r in got if r["place"] == key} == {len(want)}


# ---------------------------------------------------------------------------
# Merkle manifest
# ---------------------------------------------------------------------------
def leaf_of(row, text):
    cells = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells))


def tree(leaves):
    """Root, and for every leaf its steps (left, right)."""
    steps = [[] for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for j, (_, below) in enumerate(run):
                for i in below:
                    steps[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            above.append((h(*(d for d, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], steps


def manifest_of(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    out, tops = [], []
    for name in names:
        mine = sorted(by_source[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        top, steps = tree([leaf_of(r, r["text"]) for r in mine])
        tops.append(top)
        out.append((mine, top, steps))
    root, high = tree(tops)
    found = []
    for (mine, top, steps), above in zip(out, high):
        for row, own in zip(mine, steps):
            path, leaf, text = own + above, leaf_of(row, row["text"]), row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of(row, text)
            for left, right in path:
                folded = h(left, folded, right)
            found.append((row["doc_id"], leaf, top, root, h(*(a + b for a, b in path)), folded, folded == root))
    return sorted(found, key=repr)


def run_manifest(spark, tmp_path, rows, schema=DOCS):
    path = tmp_path / "sf"
    spark.createDataFrame(rows, schema).write.parquet(str(path / "documents.parquet"))
    got = QUERIES["op12_merkle_manifest"](spark, str(path))
    order = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr)


def test_manifest_equals_brute_force(spark, tmp_path):
    rows = [(i, f"Text {i} Ä" * (i % 3), "en", "hot" if i % 3 else f"s{i % 40}", i) for i in range(700)]
    rows += [(9000 + i, None if i % 2 else "", None, None, None) for i in range(18)]  # a run of two behind one of sixteen
    rows += [(8000, "Alone", "de", "é lone", 5), (None, "No Id", "de", "é lone", 5)]
    rows += [(8100, "Twice", "de", "twice", 5)] * 2 + [(8100, "Other", "de", "twice", 5)]
    rows += [(7777, "LONG " * 100_000, "en", "hot", 1)]
    got = run_manifest(spark, tmp_path, rows)
    names = [f.split()[0] for f in DOCS.split(", ")]
    assert got == manifest_of([dict(zip(names, r)) for r in rows])
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("count", [1, 16, 17, 257])
def test_manifest_of_one_source(spark, tmp_path, count):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(count)]
    names = [f.split()[0] for f in DOCS.split(", ")]
    got = run_manifest(spark, tmp_path, rows)
    assert got == manifest_of([dict(zip(names, r)) for r in rows])
    if count == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h()


def test_manifest_of_nothing_and_of_other_columns(spark, tmp_path):
    assert run_manifest(spark, tmp_path, []) == []
    docs = spark.createDataFrame([(1, "a", "en", "s", 1, "x", "y")], DOCS + ", leaf string, place string")
    row = merkle.manifest(docs).first()
    assert row["leaf"] == row["root"] == leaf_of({"doc_id": 1, "source": "s", "lang": "en", "n_chars": 1}, "a")


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_merkle_manifest"])
def test_query_equals_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    cursor = connect(sf).execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, cursor.fetchall())


# ---------------------------------------------------------------------------
# Chat formatting
# ---------------------------------------------------------------------------
CHATS = "conv_id long, turn long, role string, text string"


@given(st.text(alphabet="\\<>|[]/simINSTYend_start\n ", max_size=60) | st.lists(st.sampled_from([*chat.CONTROL_STRINGS, "\\", "<", "a"])).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(text):
    shown = chat.escape(text)
    assert chat.unescape(shown) == text
    assert not any(c in shown for c in chat.CONTROL_STRINGS)
    assert chat.read_turn(chat.marked_turns([(text, text)])) == (text, text)


def bracketed(turns):
    """A format with a header, bound to roles, and a closing mark that always stands at the end."""
    return "<s>" + "".join(f"[{r}] {t}\n" for r, t in turns) + "<end>"


def numbered(turns):
    return "".join(f"{i}. {r}: {t}\n" for i, (r, t) in enumerate(turns))


def forgetting(turns):
    """Leaves out what earlier answers thought."""
    cut = lambda k, t: t if k == len(turns) - 1 else t.split("</think>")[-1]
    return "".join(f"<{r}>{cut(k, t)}</{r}>" for k, (r, t) in enumerate(turns))


def strict(turns):
    for k, (r, _) in enumerate(turns):
        if r != ("user", "assistant")[k % 2]:
            raise ValueError("roles must alternate")
    return "".join(f"{r}={t};" for r, t in turns)


def spans_of(rendered, output):
    return [(output[a:b], None if c is None else output[c:d]) for a, b, c, d in rendered.spans]


def test_spans_of_a_format_with_a_trailer():
    turns = [("user", "hi"), ("assistant", "<end>"), ("user", ""), ("assistant", "a\n<end>")]
    found = chat.locate(bracketed, turns)
    assert found.trailer == "<end>" and found.rewritten_at is None
    assert found.output + found.trailer == bracketed(turns)
    assert [s for s, _ in spans_of(found, found.output)] == ["<s>[user] hi\n", "[assistant] <end>\n", "[user] \n", "[assistant] a\n<end>\n"]
    assert [loss for _, loss in spans_of(found, found.output)] == [None, "<end>", None, "a\n<end>"]


def test_rewritten_history_is_found():
    turns = [("user", "q"), ("assistant", "<think>x</think>one"), ("user", "r"), ("assistant", "two")]
    found = chat.locate(forgetting, turns)
    assert found.rewritten_at == 2
    assert found.spans[1] == (None,) * 4  # it was changed when turn 2 came
    start, end, *_ = found.spans[3]
    assert found.output[start:end] == "<assistant>two</assistant>"
    plain = chat.locate(forgetting, [("user", "q"), ("assistant", "one"), ("user", "r")])
    assert plain.rewritten_at is None and all(s[0] is not None for s in plain.spans)


@pytest.mark.parametrize("template", [chat.marked_turns, bracketed, numbered, forgetting])
def test_blocks_give_the_whole_rendering(spark, template):
    """Long conversations in blocks: put together they are what the template makes of all turns."""
    turns = [("system" if i == 0 else ("assistant", "user")[i % 2], f"t{i} <|im_end|> <think>z</think>") for i in range(23)]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(turns)] + [(2, 0, "user", "alone")]
    blocks = chat.format_chat(spark.createDataFrame(rows, CHATS), template, block=5).collect()
    mine = sorted((b for b in blocks if b["conv"] == 1), key=lambda b: b["block"])
    text = "".join(b["formatted"] for b in mine)
    assert text == template(turns)
    assert [t["place"] for b in mine for t in b["turns"]] == list(range(23))
    if template is forgetting:
        assert len(mine) == 1 and mine[0]["rewritten_at"] is not None
    elif template is numbered:
        assert len(mine) == 1  # numbers depend on all turns before
    else:
        assert len(mine) == 5
        shown = [b["formatted"][t["start"] : t["end"]] for b in mine for t in b["turns"]]
        assert "".join(shown) + ("<end>" if template is bracketed else "") == text
        told = [b["formatted"][t["loss_start"] : t["loss_end"]] for b in mine for t in b["turns"] if t["loss_start"] is not None]
        want = [t for r, t in turns if r == "assistant"]
        assert [chat.unescape(x) if template is chat.marked_turns else x for x in told] == want


def test_a_template_may_refuse(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "user", "b")]
    got = {b["conv"]: b for b in chat.format_chat(spark.createDataFrame(rows, CHATS), strict).collect()}
    assert got[1]["formatted"] == "user=a;assistant=b;" and got[1]["error"] is None
    assert got[2]["formatted"] is None and "alternate" in got[2]["error"]
    long = [(3, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(12)]
    (whole,) = chat.format_chat(spark.createDataFrame(long, CHATS), strict, block=4).collect()
    assert whole["error"] is None and whole["formatted"].startswith("user=t0;") and len(whole["turns"]) == 12


def test_chat_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", None), (5, 1, "assistant", "b"), (5, 1, "assistant", "b"), (5, 0, "us\\er\n", "")]
    rows += [(6, 0, "assistant", "Ä" * 300_000)]
    df = spark.createDataFrame(rows, CHATS).withColumn("block", F.lit(1)).withColumn("place", F.lit("x"))
    got = {r["conv"]: r for r in chat.chat_digests(chat.format_chat(df)).collect()}
    assert got[None]["n_turns"] == 2 and got[None]["turns_sha256"] == h("\n\n", "assistant\n\n")
    assert got[5]["turns_sha256"] == h("us\\er\n\n\n", "assistant\nb\nassistant\nb\n") and got[5]["loss_chars"] == 2
    assert got[6]["loss_chars"] == 300_000 and got[6]["loss_sha256"] == h("Ä" * 300_000)
    assert chat.chat_digests(chat.format_chat(df.limit(0))).collect() == []


def test_a_hot_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(700)] + [(i, 0, "user", "x") for i in range(2, 40)]
    blocks = chat.format_chat(spark.createDataFrame(rows, CHATS))
    assert blocks.filter("conv = 1").count() == -(-700 // chat.BLOCK)
    got = {r["conv"]: r for r in chat.chat_digests(blocks).collect()}
    assert len(got) == 39
    assert got[1]["turns_sha256"] == h(*(f"{r}\n{t}\n" for _, _, r, t in rows[:700]))
    assert got[1]["loss_sha256"] == h(*(t for _, _, r, t in rows[:700] if r == "assistant"))


# ---------------------------------------------------------------------------
# Whitening
# ---------------------------------------------------------------------------
def scatter(x):
    c = x - x.mean(axis=0)
    return c.T @ c


@given(st.integers(1, 12), st.integers(1, 30), st.integers(0, 3), st.integers(0, 10**6))
@settings(max_examples=200, deadline=None)
def test_spectrum_equals_eigh(size, rows, repeats, seed):
    """Also with fewer rows than dimensions, repeated rows and equal eigenvalues."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (rows, size)).astype(float) + 1000
    x = np.concatenate([x] + [x[:1]] * repeats)
    half = whitening.Spectrum.empty(size)
    half.add_rows(x[: len(x) // 2 + 1])
    if len(x) // 2 + 1 < len(x):
        rest = whitening.Spectrum.empty(size)
        rest.add_rows(x[len(x) // 2 + 1 :])
        half.add(rest)
    want = scatter(x)
    scale = max(1.0, np.abs(want).max())
    assert half.n == len(x) and np.allclose(half.mean, x.mean(axis=0))
    assert np.abs(np.linalg.eigvalsh(want) - half.values).max() < 1e-12 * scale * size
    assert np.abs(half.vectors.T @ half.vectors - np.eye(size)).max() < 1e-12
    assert np.abs(half.vectors @ np.diag(half.values) @ half.vectors.T - want).max() < 1e-12 * scale * size


def test_whitening_equals_eigh(spark, sf):
    out = QUERIES["op13_whitening"](spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(1024 * np.stack(table["embedding"]).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    want = c @ vectors / np.sqrt(values)
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-9
    first = out.drop_duplicates("component").sort_values("component")
    assert np.allclose(first["explained"], values / np.trace(c.T @ c / n), rtol=1e-12)
    assert out["identity_error"].max() < 1e-10 and out["identity_error"].nunique() == 1
    deviation = out.drop_duplicates("vec_id").set_index("vec_id")["deviation"].loc[table["vec_id"]]
    assert (deviation.to_numpy() == ((n * x - s) ** 2).sum(axis=1)).all()


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.5, -2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (8, [1.0]), (9, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "x int, embedding array<float>").withColumn("whitened", F.lit("kept"))
    got, found = whitening.whiten(df)
    cells = got.orderBy("x").collect()
    assert [r["x"] for r in cells] == [1, 2, 9] and found.n == 3
    assert got.columns == ["x", "embedding", "whitened", "deviation", "_whitened"]
    # All lie on a line: one component, the other has no variance.
    assert all(len(r["_whitened"]) == 2 and r["_whitened"][1] is None for r in cells)
    assert np.isclose(np.mean([r["_whitened"][0] ** 2 for r in cells]), 1) and found.explained.tolist() == [1.0, 0.0]
    same, flat = whitening.whiten(df.filter("x in (1, 9)"))
    assert [r["_whitened"] for r in same.collect()] == [[None, None]] * 2 and flat.identity_error == 0
    none, fit = whitening.whiten(df.filter("x in (3, 4, 5)"))
    assert none.collect() == [] and fit is None
    far = spark.createDataFrame([(1, [3e38]), (2, [-3e38])], "vec_id int, embedding array<float>")
    big, _ = whitening.whiten(far)
    assert [r["deviation"] for r in big.collect()] == [None, None]  # beyond a long
