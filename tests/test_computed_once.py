"""Work that must not be repeated or moved around as tables grow."""

from datetime import date

import pyarrow as pa
from conftest import plan_of
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.match import _first_chars
from presslake.operators import joins, quality, rollup_store, search_index
from presslake.sources import store


def counting(spark, column, kind):
    """The column passed through a function that counts its rows."""
    seen = spark.sparkContext.accumulator(0)

    def run(value):
        seen.add(1)
        return value

    return seen, F.udf(run, kind).asNondeterministic()(column)


def test_a_rollup_batch_is_computed_once(spark, tmp_path):
    seen, source = counting(spark, F.concat(F.lit("s"), (F.col("id") % 3).cast("string")), "string")
    batch = spark.range(20).select(F.lit(date(2025, 11, 4)).alias("collection_date"), source.alias("source"), F.lit(5).alias("content_length"), F.struct(F.array(F.lit("oil")).alias("matched_keywords")).alias("tags"))
    rollup_store.add_batch(batch, str(tmp_path / "r"), "a")
    assert seen.value == 20
    assert rollup_store.archive_totals(spark, str(tmp_path / "r")).first()["total_articles"] == 20


def test_scores_are_computed_once(spark):
    seen, score = counting(spark, F.col("id") / 7, "double")
    rows = spark.range(30).select(score.alias("score"), (F.col("id") > 14).cast("int").alias("label"))
    assert tuple(quality.auc(rows).first()) == (15, 15, 1.0)
    assert seen.value == 30


def test_whole_rows_are_joined_only_where_some_stay(spark):
    row = lambda *ids: spark.createDataFrame([(date(2025, 11, 4), i, "text") for i in ids], "collection_date date, article_id string, content string")
    table = row("a", "b", None)
    assert "Join" not in plan_of(store._without(table, row("c", None)))
    assert store._without(row("a", "b"), row("b", "a", "a")).count() == 0
    assert {r["article_id"] for r in store._without(table, row("a", None)).collect()} == {"b", None}


def test_terms_of_rare_lengths_are_scanned(spark):
    texts = spark.createDataFrame([(1, "a fine u.s.a and c++x here"), (2, "fine"), (3, None)], "id long, body string")
    lexicon = spark.createDataFrame([(t,) for t in ("fine", "here", "and", "c++", "u.s.")], "term string")
    found = joins.join_matches(texts, lexicon, "id", "body")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "and"), (1, "c++"), (1, "fine"), (1, "here"), (1, "u.s."), (2, "fine")]
    assert joins._run_pattern(4, True, False) not in found._jdf.queryExecution().optimizedPlan().toString()


def test_postings_of_a_batch_are_those_of_its_grams(spark):
    rows = [("d1", "b0", 0, "ab", "xabc"), ("d1", "b0", 1, "", "ü😀b"), ("d1", "b1", 0, "abc", ""), ("d2", "b0", 7, "", "")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 2 else pa.string()) for i, c in enumerate(zip(*rows, strict=True))], names=["collection_date", "block", "slot", "f", "g"])
    got = {(d, b, g): s for part in search_index._lists([batch]) for d, b, g, s in zip(*(c.to_pylist() for c in part.columns), strict=True)}
    frame = spark.createDataFrame(rows, "d string, b string, slot int, f string, g string")
    each = frame.select("d", "b", "slot", F.explode(F.array_distinct(F.concat(search_index.grams(F.col("f")), search_index.grams(F.col("g"))))).alias("gram"))
    want: dict = {}
    for d, b, slot, gram in sorted(tuple(r) for r in each.collect()):
        want.setdefault((d, b, gram), []).append(slot)
    assert got == want


def test_trees_are_tried_where_three_characters_fit():
    assert _first_chars(["abcd", "xbz"]) == "[ax][b][cz]"


def test_senate_and_other_pages_are_read_in_one_python_step(spark):
    pages = spark.createDataFrame([("https://www25.senado.leg.br/web/materia/1", "<h1>x</h1><div id='textoMateria'><p>t</p></div>"), ("u", "<main><p>plain</p></main>")], "url string, html string")
    assert plan_of(H.extract_content(pages)).count("ArrowEvalPython") == 1
