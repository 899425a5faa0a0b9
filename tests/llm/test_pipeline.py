"""The stages of the pipeline, each against what its input asks for."""

import sys
from pathlib import Path

import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as pipeline  # noqa: E402
import public_tokenizers as tokenizers  # noqa: E402

from presslake.llm import bpe, decontam, toxicity  # noqa: E402
from presslake.llm.queries import VOCABULARY, toxicity_chain  # noqa: E402
from tests.llm.test_dedup import brute_classes  # noqa: E402


@pytest.fixture(scope="module")
def results(spark, sf, tmp_path_factory):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(results):
    assert all(r.columns == results[0].columns for r in results[:-1])


def test_toxicity_stage(spark, sf, results):
    chain = toxicity_chain(spark, sf, results[0])
    judged = toxicity.judge(results[0], chain, lambda c: c == "toxic")
    assert set(texts(results[1])) == {r["doc_id"] for r in judged.filter("kept").collect()}


def test_exact_stage(results):
    before = texts(results[1])
    last = {t: d for d, t in sorted(before.items())}
    assert set(texts(results[2])) == set(last.values())


def test_near_stage(results):
    before = texts(results[2])
    roots = brute_classes(list(before.items()))
    assert set(texts(results[3])) == set(roots.values())


def test_leak_stage(spark, sf, results):
    before = texts(results[3])
    items = [f" {' '.join(decontam.words_in(r['text'].lower()))} " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {d for d, t in before.items() if not any(x in f" {' '.join(decontam.words_in(t.lower()))} " for x in items)}
    assert set(texts(results[4])) == clean and len(clean) < len(before)


def test_token_stage(results):
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(tokenizers.path(VOCABULARY)), special_tokens={})
    ids = {r["doc_id"]: r["ids"] for r in results[5].collect()}
    assert ids == {d: library.encode_ordinary(t) for d, t in texts(results[4]).items()}


def test_run_returns_the_last_stage(spark, sf, results):
    key = lambda df: sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in df.collect())
    assert key(pipeline.run(spark, sf)) == key(results[-1])


def test_stages_take_odd_rows(spark, sf, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, class_id long"
    rows = [(1, None, None, None, None, None, None), (2, "", None, None, 0, True, 1), (None, "some words here", "en", "s", 5, None, None)] * 2
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, frame, sf)
            assert name == "tokenize" or out.columns == docs.columns
            assert out.count() <= frame.count()
    assert pipeline.drop_copies(spark, docs, sf).count() == 2
