"""Token ids, secrets, licenses, URLs and page text against plain Python."""

import hashlib
import html
import re

import public_tokenizers as tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.llm import bpe, extract, licenses, secrets, urls
from presslake.llm.queries import QUERIES, VOCABULARY

RANKS = bpe.read_ranks(tokenizers.path(VOCABULARY))
TREE = bpe.TreeBpe(RANKS, tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab e=-\n", max_size=300))
def test_encoding_equals_library_and_round_trips(text):
    ids = TREE.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert TREE.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=60))
def test_join_is_the_encoding_of_the_whole(left, right):
    assert TREE.join(TREE.reduce(left), TREE.reduce(right)) == TREE.merge(left + right)


def test_token_table(spark):
    text = "word " * 20_000 + "x" * 3000
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "Ça va?", 0), (3, "Ça va?", 0), (4, text, 0)], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_table(df, tokenizers.path(VOCABULARY), tokenizers.PATTERN).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 3, 3, 4]
    for r in rows:
        whole = {1: "", 2: "", 3: "Ça va?", 4: text}[r["doc_id"]]
        ids = LIBRARY.encode_ordinary(whole)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
    encoded = bpe.encode_table(df, tokenizers.path(VOCABULARY), tokenizers.PATTERN)
    back = encoded.select("doc_id", bpe.decode_column(F.col("ids"), tokenizers.path(VOCABULARY), tokenizers.PATTERN).alias("b")).collect()
    assert {r["doc_id"]: bytes(r["b"]).decode() for r in back}[4] == text
    assert bpe.encode_table(df.limit(0), tokenizers.path(VOCABULARY), tokenizers.PATTERN).count() == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_secret_digests_equal_brute_force(spark, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op5_secret_scan"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc, text in docs:
        text = text or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        shown = [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]
        assert rows[doc]["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert set(shown) <= set(rows[doc]["spans"].split(",")) | {""}
        assert rows[doc]["n_assign"] == sum(k == "assign" for *_, k in spans)


def test_secrets_of_a_text(spark):
    text = 'my pwd is Xk9$vQ2!mP and password = "hunter22" Authorization: Bearer abC9x-Zk2Q_p0 api key: changeme123 pin: 123456'
    found = [(kind, text[a:b]) for a, b, kind in secrets.secret_spans(text)]
    assert found == [("guess", "Xk9$vQ2!mP"), ("assign", 'password = "hunter22'), ("guess", "abC9x-Zk2Q_p0")]
    assert secrets.secret_spans("token: ſecret") == [] and secrets.secret_spans("pass=short") == []
    df = spark.createDataFrame([(None, 1), ("", 2), (text, 3)], "text string, secrets int")
    out = secrets.scan_secrets(df)
    assert {r["secrets"]: len(r["_secrets"]) for r in out.collect()} == {1: 0, 2: 0, 3: 3}
    assert secrets.scan_secrets(df.limit(0)).count() == 0


def test_guess_costs_are_in_order():
    cost = secrets.GuessCost().log10
    assert cost("") == 0
    assert cost("password1") < cost("qwerty12345") < cost("2024-05-17") < cost("hunter2") < cost("tr0ub4dor&3") < cost("x7#Kp!9vQz2L")
    assert cost("aaaaaaaaaaaa") < 4 and cost("abcabcabcabc") < 6 and cost("a" * 50_000) < 8
    # Never more than brute force over everything.
    assert all(cost(v) <= sum(map(secrets.GuessCost._brute, v)) + 1e-9 for v in ("f2f5acd241f026fd29", "ZZtop99", "pass1pass2"))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_low(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def license_row(text):
    words, places, base, met, score = WORD.findall(ascii_low(text)), [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append(i)
                base.add(label)
    for line in text.split("\n"):
        held = set(WORD.findall(ascii_low(line)))
        for label, template in licenses.TEMPLATES:
            own = set(WORD.findall(ascii_low(template)))
            rivals = [set(WORD.findall(ascii_low(t))) for name, t in licenses.TEMPLATES if name != label]
            told = all(held & (own - r) for r in rivals if len(own & r) / len(own) >= licenses.THRESHOLD)
            if told and len(held & own) / len(own) >= licenses.THRESHOLD:
                met.add(label)
                score = max(score, len(held & own) / len(own))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | met)), score)


LICENSE_COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_licenses_equal_brute_force(spark, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op6_license_scan"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert {d: tuple(rows[d][c] for c in LICENSE_COLUMNS) for d, _ in docs} == {d: license_row(t or "") for d, t in docs}


def test_a_notice_has_the_label_it_names(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "licensed under cc by 4.0", "Licensed under CC BY-NC 4.0. x CC BY-SA 4.0 licensed under"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(df).collect()}
    assert got == {0: "cc-by-nc", 1: "cc-by-sa", 2: "", 3: "cc-by-nc,cc-by-sa"}


def test_licenses_of_odd_texts(spark):
    texts = [
        None, "", "MIT License MIT\nlicense", "the mit, LICENSE; Apache-License general public license", "all RIGHTS reserved",
        "reserved rights of all kinds", "Permission is hereby granted free of charge to any person with a copy of this software and documentation files",
        "mit license " * 5000, "MİT License", "license mit", "\n\n\n",
    ]
    df = spark.createDataFrame([(i, t, "own", 1) for i, t in enumerate(texts)], "doc_id long, text string, labels string, words int")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        assert tuple(rows[i]["_labels" if c == "labels" else c] for c in LICENSE_COLUMNS) == license_row(t or ""), t
        assert rows[i]["labels"] == "own"
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    doubled = licenses.scan_licenses(df.union(df)).groupBy("doc_id").count().filter("count = 2").count()
    assert doubled == len(texts)


def test_license_scan_runs_no_python(spark, sf):
    plan = QUERIES["op6_license_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "a.org", "/x"), ("allow", "a.org", "/x/y")]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (None, ("", "", None, "allow")),
        ("no scheme casino", ("", "", None, "block")),
        ("http://WWW.Example.ORG/es/1?q=://x#f", ("www.example.org", "/es/1", "example.org/es/", "block")),
        ("http://example.org", ("example.org", "", None, "allow")),
        ("http://notexample.org/es/", ("notexample.org", "/es/", "org/", "allow")),
        ("https://sub.a.org/x/y/z", ("sub.a.org", "/x/y/z", "a.org/x/y", "allow")),
        ("https://a.org/xq", ("a.org", "/xq", "a.org/x", "block")),
        ("http://free-bet.net/win", ("free-bet.net", "/win", None, "block")),
        ("http://free.net/free", ("free.net", "/free", None, "allow")),
        ("http://freewin.net/essex", ("freewin.net", "/essex", None, "allow")),
        ("http://x.net/my_casino-2/", ("x.net", "/my_casino-2/", None, "block")),
        ("http://x.net/casinos", ("x.net", "/casinos", None, "allow")),
        ("ftp://x.net#casino", ("x.net", "", None, "block")),
    ],
)
def test_urls(spark, url, want):
    df = spark.createDataFrame([(url, 5)], "url string, rule int")
    row = urls.judge_urls(df, RULES).first()
    assert (row["host"], row["path"], row["_rule"], row["verdict"]) == want and row["rule"] == 5


def test_urls_of_an_empty_table(spark):
    assert urls.judge_urls(spark.createDataFrame([], "url string"), RULES).count() == 0


def test_page_text_equals_the_article(spark, sf):
    rows = {r["page_id"]: r for r in QUERIES["op9_main_text"](spark, sf).collect()}
    for page, source in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect():
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert rows[page]["text"] == want and rows[page]["n_chars"] == len(want)


def test_page_text_without_an_article(spark, sf):
    """The scan alone finds the paragraphs when no element names them."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    weights = extract.fit_weights(pages)
    same = 0
    rows = pages.select("html").collect()
    for (source,) in rows:
        plain = source.replace("<article>", "").replace("</article>", "")
        same += extract.main_text(plain, weights) == extract.main_text(source, weights)
    assert same >= 0.95 * len(rows)


def test_parts_left_out_of_an_article(spark, sf):
    weights = extract.fit_weights(spark.read.parquet(f"{sf}/pages.parquet"))
    words = "One two three four five six seven eight nine ten. " * 5
    page = f"""<html><head><title>T</title></head><body><header>Top</header><nav><a href=x>Menu</a></nav><article><h1>Head &amp; line</h1>
    <p>{words}<br>new line</p><aside>side</aside><div class="ad-box ads">buy</div><div id="comments"><p>first!</p></div><form><input>send</form>
    <script>var t = "</p>"; if (1 < 2) x();</script><ul><li>point&nbsp;a<li>point b</ul><div class="cookie-notice">ok?</div><p>Last  one.</p></article>
    <footer>(c)</footer></body></html>"""
    text = extract.main_text(page, weights)
    assert text == "\n".join(["Head & line", " ".join((words + " new line").split()), "point a", "point b", "Last one."])


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, "just words", "u"), (4, "<p>a<p>b", "u"), (5, "<" * 2000, "u"), (6, '<p class="x' + "<b>" * 3000, "u"), (7, "<div>" * 5000 + "word", "u")], "page_id long, html string, text string")
    rows = {r["page_id"]: r["_text"] for r in extract.extract_pages(df, {}).collect()}
    assert rows[1] == rows[2] == "" and rows[3] == "just words"
    assert extract.extract_pages(df.limit(0), {}).count() == 0
    assert extract.fit_weights(df.limit(0)) == {}


def test_secrets_of_prefixed_names_and_letters_only():
    lines = {
        "passphrase: KxvQwrTzLmNpBdYhGcSf": "KxvQwrTzLmNpBdYhGcSf",
        "AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY": "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY",
        "DB_PWD=Xk9$vQ2!mPz8": "Xk9$vQ2!mPz8",
        'db_password="p@$$!9xQz#1Lk"': "p@$$!9xQz#1Lk",
        "pin: qzxkvbtrwpmfghdlncjsqzxkvbtrwpmfghdlncjs": "qzxkvbtrwpmfghdlncjsqzxkvbtrwpmfghdlncjs",
        "dbPassword := Xk9$vQ2!mPz8": "Xk9$vQ2!mPz8",
    }
    for line, value in lines.items():
        assert [line[a:b] for a, b, kind in secrets.secret_spans(line) if kind == "guess"] == [value], line
    for line in ("the secret is understanding", "password: Zusammenarbeit", "author: Xk9$vQ2!mPz8", "auth is required here", "pin: someVariableName"):
        assert not [x for x in secrets.secret_spans(line) if x[2] == "guess"], line


def test_wrapped_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"
    gpl = " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General\n * Public License as published"
    bsd = "Redistribution and use in source and binary forms,\nwith or without\nmodification, are permitted provided that\nthe following\nconditions are met:"
    texts = [mit, gpl, bsd, mit.replace("\n", "\n\n"), "x " * 500 + mit + " y" * 500, "all\n" + "word " * 40 + "\nrights reserved"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(df).collect()}
    assert rows[0] == ("mit", 1.0) and rows[1] == ("gpl", 1.0) and rows[2] == ("bsd", 1.0) and rows[4] == ("mit", 1.0)
    assert rows[3] == rows[5] == ("", 0.0)


@pytest.mark.parametrize("wrapper", ["content no-sidebar", "has-sidebar", "with-comments", "nav-open", "widget-content", "related-work", "notice-board", "sidebar", "widget"])
def test_layout_classes_keep_the_article(spark, sf, wrapper):
    weights = extract.fit_weights(spark.read.parquet(f"{sf}/pages.parquet"))
    words = "One two three four five six seven eight nine ten."
    blocks = "".join(f"<p>{words}</p>" for _ in range(8))
    inner = f"<div class='{wrapper}'>{blocks}</div><div class='sidebar-left'>aside</div><div class='comment-list'>first</div>"
    want = "\n".join([words] * 8)
    for page in (f"<html><body><article>{inner}</article></body></html>", f"<html><body><div class='{wrapper}'><article>{blocks}</article></div></body></html>"):
        assert extract.main_text(page, weights) == want
    part = f"<article>{blocks}<p>a <math><mi>x</mi></math> <object>o</object> <label>l</label></p><div class='related-posts'>r</div></article>"
    assert extract.main_text(part, weights) == want + "\na x o l"
