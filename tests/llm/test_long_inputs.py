"""Pages and texts whose shape must not cost more than their length: in seconds, and right."""

import random
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from presslake.llm import bagminhash, bpe, common, extract


@pytest.fixture(scope="module")
def codec():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.TreeBpe(ranks, public_tokenizers.PATTERN), library


@pytest.mark.parametrize("text", ["x" * 60_000, "=" * 50_000, "ab" * 30_000, "=-" * 30_000, "aaab" * 10_000, "é" * 20_000, " " * 50_000])
def test_long_runs_encode_as_the_library_does(codec, text):
    own, library = codec
    start = time.time()
    ids = own.encode(text)
    assert time.time() - start < 30
    assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_a_million_equal_characters(codec):
    own, _ = codec
    start = time.time()
    ids = own.encode("x" * 1_000_000)
    assert time.time() - start < 60
    # By the plain merge of the whole, which has no seams.
    assert ids == own.merge_long(b"x" * 1_000_000)


def test_the_heap_merges_as_the_list_does(codec):
    own, library = codec
    random.seed(3)
    for _ in range(2000):
        text = "".join(random.choices("abx= =\n.é1", k=random.randrange(1, 300)))
        assert own.encode(text) == library.encode_ordinary(text)
        data = text.encode()[:128]
        assert own.merge_long(data) == own.merge(data)


WEIGHTS: dict = {}


@pytest.mark.parametrize(
    "page",
    ["<a " * 20_000, "<script " * 8_000, "<b>x " * 20_000, "<foo>x " * 20_000, '<a x=">" ' * 20_000, "<a x='" * 20_000 + ">", "<!--" * 20_000,
     "</" * 30_000, "<p>x" * 20_000, "<" * 60_000, '<a ="' * 20_000 + "'>"],
)
def test_broken_pages_are_read_in_time(page):
    start = time.time()
    extract.main_text(page, WEIGHTS)
    assert time.time() - start < 5


def shown(page):
    return " ".join(" ".join(text for kind, _, text, dropped, _ in extract.tokens(page) if kind == "word" and not dropped).split())


def test_quotation_marks_count_behind_equals_only():
    assert shown("<p title=don't>Hello world here</p><p>It's ok now</p><p>third</p>") == "Hello world here It's ok now third"
    assert shown('<a href="x>y" t = \'a>b\'>z</a>') == "z"
    assert shown("<p data='<b>q</b>'>r</p> 1 < 2") == "r 1 < 2"
    assert shown('<p x="open>text</p> more') == "text more"
    assert shown("a <b") == "a < b"


def most_held(run, batch):
    """The largest number of bytes numpy and Python held while `run` went over a batch, and its rows."""
    tracemalloc.start()
    rows = most = 0
    for out in run(iter([batch])):
        rows += out.num_rows
        most = max(most, out.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak, most, rows


def test_near_duplicates_hold_a_portion_of_a_batch_at_once():
    n, each = 1000, 1000
    keys = pa.array([i.to_bytes(16, "big") for i in range(n)])
    hashes = np.random.default_rng(1).integers(1 << 62, size=n * each)
    words = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * each), pa.array(hashes))
    texts = pa.RecordBatch.from_arrays([keys, words], names=["key", "words"])
    lists = pa.RecordBatch.from_arrays([keys, pa.array([hashes[i : i + each].tobytes() for i in range(0, n * each, each)])], names=["key", "shingles"])
    # A batch of 8 MB: some ten arrays of its size were held, and a batch of 36 MB came back.
    peak, _, rows = most_held(lambda b: bagminhash._sorted_shingles(b, 5), texts)
    assert rows == n and peak < 16 << 20
    peak, most, rows = most_held(bagminhash._single_shingles, lists)
    assert rows == n * each and most < 4 << 20 and peak < 16 << 20


def test_portions_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(7))], names=["i"])
    cut = lambda sizes, most: [p.column("i").to_pylist() for p in common.portions(batch, np.array(sizes), most)]
    assert cut([1, 2, 3, 9, 0, 0, 4], 5) == [[0, 1], [2], [3], [4, 5, 6]]
    assert cut([0] * 7, 5) == [list(range(7))] and cut([9] * 7, 5) == [[i] for i in range(7)]
    assert list(common.portions(batch.slice(0, 0), np.zeros(0, "i8"), 5)) == []


def test_workers_return_what_they_have_freed():
    freed = []
    pool = type("Pool", (), {"release_unused": lambda self: freed.append(1)})()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common.pa, "default_memory_pool", lambda: pool)
        patch.setattr(common.pa, "system_memory_pool", lambda: pool)
        assert list(common.tidy(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3]
    assert len(freed) == 2
