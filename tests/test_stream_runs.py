"""Streams over several runs: new checkpoints, fresh runs, keyed state."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from presslake.streaming import dedupe, ingest

SCHEMA = "url string, ts timestamp, day date"


def put(spark, path, rows):
    df = spark.createDataFrame([(u, datetime(2025, 11, d, 10)) for u, d in rows], "url string, ts timestamp")
    df.withColumn("day", F.col("ts").cast("date")).coalesce(1).write.mode("append").parquet(path)


def urls(spark, path):
    return sorted((r["url"], r["day"].day) for r in spark.read.parquet(path).collect())


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    out = str(tmp_path / "out")

    def run(name, checkpoint, fresh=False):
        stream = ingest.ingest_stream(spark, str(tmp_path / name), SCHEMA, max_files=1).select("url", "day")
        ingest.run_to_end(ingest.append_new(stream, out, ["url"], "day", fresh=fresh), str(tmp_path / checkpoint))

    put(spark, str(tmp_path / "a"), [("u1", 1), ("u2", 2), ("u1", 1)])
    run("a", "c1")
    put(spark, str(tmp_path / "b"), [("u3", 2), ("u2", 2)])
    run("b", "c2")
    assert urls(spark, out) == [("u1", 1), ("u2", 2), ("u3", 2)]
    run("a", "c3")  # the same files again
    assert urls(spark, out) == [("u1", 1), ("u2", 2), ("u3", 2)]
    put(spark, str(tmp_path / "f"), [("n1", 2)])
    put(spark, str(tmp_path / "f"), [("n2", 2), ("n1", 2), ("n3", 3)])
    run("f", "c4", fresh=True)
    assert urls(spark, out) == [("n1", 2), ("n2", 2), ("n3", 3), ("u1", 1)]
    put(spark, str(tmp_path / "f"), [("n4", 2), ("u9", 1)])
    run("f", "c4", fresh=True)  # a restart: its days are its own already, day 1 is new to it
    assert urls(spark, out) == [("n1", 2), ("n2", 2), ("n3", 3), ("n4", 2), ("u9", 1)]
    run("b", "c5")
    assert urls(spark, out) == [("n1", 2), ("n2", 2), ("n3", 3), ("n4", 2), ("u2", 2), ("u3", 2), ("u9", 1)]


def test_counts_of_several_runs(spark, tmp_path):
    out = str(tmp_path / "out")

    def run(name, checkpoint, fresh=False):
        stream = ingest.ingest_stream(spark, str(tmp_path / name), SCHEMA, max_files=1)
        ingest.run_to_end(ingest.add_counts(stream, out, [], fresh=fresh), str(tmp_path / checkpoint))
        return {r["day"].day: r["articles"] for r in ingest.total_counts(spark, out, []).collect()}

    for day in (1, 2, 3):
        put(spark, str(tmp_path / "a"), [("u", day)] * day)
    assert run("a", "c1") == {1: 1, 2: 2, 3: 3}
    put(spark, str(tmp_path / "b"), [("u", 5), ("u", 3)])
    assert run("b", "c2") == {1: 1, 2: 2, 3: 4, 5: 1}
    put(spark, str(tmp_path / "f"), [("u", 3)])
    put(spark, str(tmp_path / "f"), [("u", 3), ("u", 2)])
    assert run("f", "c3", fresh=True) == {1: 1, 2: 1, 3: 2, 5: 1}
    put(spark, str(tmp_path / "b"), [("u", 3)])
    assert run("b", "c2") == {1: 1, 2: 1, 3: 3, 5: 1}


def test_keyed_state_keeps_late_rows_apart_and_forgets_closed_days(spark, tmp_path):
    files, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run(checkpoint=check):
        stream = ingest.ingest_stream(spark, files, SCHEMA, max_files=1).select("url", "ts")
        kinds = dedupe.first_per_day(stream, ["url"], delay=timedelta(hours=1))
        query = ingest.run_to_end(dedupe.write_kinds(kinds, out), checkpoint)
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    put(spark, files, [("a", 1), ("b", 1), ("a", 1), (None, 1)])
    run()
    put(spark, files, [(f"n{i}", 9) for i in range(30)] + [("a", 9)])
    put(spark, files, [("a", 1), ("late", 1), ("a", 9)])
    held = run()
    put(spark, files, [("z", 20)])
    held += run()
    put(spark, files, [("z", 20)])
    held += run()
    rows = [(str(r["url"]), r["ts"].day, r["kind"]) for r in spark.read.parquet(out).collect()]
    # Day 1 is closed: "a" and "late" are not compared any more, but not lost.
    want = [("a", 1, "first"), ("b", 1, "first"), ("None", 1, "first"), ("a", 9, "first"), ("z", 20, "first"), ("a", 1, "late"), ("late", 1, "late")]
    assert sorted(r for r in rows if not r[0].startswith("n")) == sorted(want)
    settled = sorted((str(r["url"]), r["ts"].day) for r in dedupe.settled(spark, out, ["url"]).collect())
    expected = sorted([("a", 1), ("b", 1), ("None", 1), ("late", 1), ("a", 9), ("z", 20)] + [(f"n{i}", 9) for i in range(30)])
    assert settled == expected
    # While day 9 was open its 31 keys were held; in the end only day 20 is.
    assert max(held) >= 31 and held[-1] < 10
    run(str(tmp_path / "again"))
    assert sorted((str(r["url"]), r["ts"].day) for r in dedupe.settled(spark, out, ["url"]).collect()) == expected


def test_a_fresh_run_cut_anywhere_leaves_no_mixed_articles(spark, tmp_path, monkeypatch):
    """Old and new halves never count as one article, and the next normal run completes what is missing."""
    from presslake.plans import records
    from presslake.sources import store

    def batch(ids, end):
        df = spark.createDataFrame([(f"u{i}", f"text {i}{end}", "2025-11-0%d" % (i % 2 + 1)) for i in ids], "url string, content string, d string")
        df = df.withColumns({"collection_date": F.col("d").cast("date"), "tags": records.tag_struct(F.array(F.lit("Global")))})
        return records.to_articles(df, "rss", datetime(2025, 11, 4), keep_date=True)

    def shown(base):
        pairs = store.articles(spark, base).join(store.contents(spark, base), store.KEY)
        return {r["url"]: (r["content"], r["content_length"]) for r in pairs.collect()}

    steps = store._replace
    for cut in range(4):
        base = str(tmp_path / f"store{cut}")
        store.save_articles(batch(range(6), ""), base)
        done = []

        def counted(table, path, cut=cut, done=done):
            if len(done) == cut:
                raise RuntimeError("cut")
            done.append(path)
            steps(table, path)

        monkeypatch.setattr(store, "_replace", counted)
        if cut < 3:
            try:
                store.save_articles(batch([0, 1, 2, 9], " again"), base, fresh=True)
            except RuntimeError:
                pass
        else:
            store.save_articles(batch([0, 1, 2, 9], " again"), base, fresh=True)
        monkeypatch.setattr(store, "_replace", steps)
        for content, length in shown(base).values():
            assert len(content) == length
        store.save_articles(store.new_only(batch([0, 1, 2, 9], " again"), base), base)
        got = shown(base)
        assert set(got) == {f"u{i}" for i in (0, 1, 2, 3, 4, 5, 9)}
        assert all(len(content) == length for content, length in got.values())
        assert got["u9"][0] == "text 9 again" and got["u5"][0] == "text 5"
        if cut >= 2:
            assert got["u0"][0] == "text 0 again"
