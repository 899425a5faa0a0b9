"""Benchmark decontamination by latent semantic retrieval.

Documents are read as overlapping passages. Passages and benchmark items become TF-IDF
vectors over the terms of the items (other terms cannot make a passage similar to an
item), with document frequencies counted over all documents. A distributed randomised
SVD, fitted on the items and all different documents, gives a latent space.
Every passage of every document is projected into it; items within a cosine of it
are candidates. A candidate counts when the longest common subsequence of words covers
most of the item, or half of its less common words together with those of its answer (its
last sentence, unless the items have answers of their own), which finds paraphrases.

Items are worked on in blocks of a fixed number, each with a model of its own, so
what goes to the tasks has a size bound: block * (longest item) terms times the rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import portions, staged, text_key, tidy, whole_text

STRIDE = 32
#: Passages compared with the items at once.
PASSAGES = 4096
BLOCK_ITEMS = 256
RANK = 192
#: Tasks that add up what the tasks of the fit return, and strides multiplied at once.
FIT_TASKS, FIT_STRIDES, POWER_STEPS = 8, 64, 2
#: Terms in a larger share of the documents are common. They carry no weight, but for
#: those of items with fewer than so many other terms, which they alone can find.
COMMON_SHARE, LEAST_TERMS = 0.25, 8
COSINE = 0.4
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.8
#: Words of the answer, at least, when it is taken from the item's end.
ANSWER_WORDS = 4

words_in = re.compile(r"[^\W_]+").findall
_beyond_ascii = re.compile(r"[^\x00-\x7f]").findall
#: Bytes of ASCII characters that stand between words become blanks.
_BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def word_bytes(text: str) -> list[bytes]:
    """`words_in` of the lower-case text, in UTF-8: texts are cut bytewise once other separators are blanks."""
    low = text.lower()
    if not low.isascii():
        for char in set(_beyond_ascii(low)):
            if not char.isalnum():
                low = low.replace(char, " ")
    return low.encode().translate(_BLANKED).split()


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, a bit per element of `a`."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def answer_words(text: str) -> list[str]:
    """Words of the last sentence of a text (of a single one its last third), with those before it up to ANSWER_WORDS."""
    every = words_in(text.lower())
    sentences = [own for s in re.split(r"[.!?]\s", text.lower().strip()) if (own := words_in(s))]
    last = len(sentences[-1]) if len(sentences) > 1 else len(every) // 3
    return every[-max(last, ANSWER_WORDS) :] if every else []


@dataclass
class Items:
    """One block of benchmark items as words, with the terms they use; words only answers use are numbered behind them."""

    ids: list
    words: list[list[str]]
    answers: list[list[str]]

    def __post_init__(self):
        own = {w for item in self.words for w in item}
        self.n_terms = len(own)
        self.terms = {w: i for i, w in enumerate([*sorted(own), *sorted({w for a in self.answers for w in a} - own)])}


@dataclass
class Space:
    idf: np.ndarray  # weights of the terms
    common: np.ndarray  # whether a term is common
    basis: np.ndarray  # terms x rank
    items: np.ndarray  # items x rank, unit length


def _term_rows(words: list[str], terms: dict[str, int]) -> np.ndarray:
    get = terms.get
    return np.array([get(w, -1) for w in words], dtype="i8")


def _matrix(row: np.ndarray, term: np.ndarray, n_rows: int, idf: np.ndarray) -> np.ndarray:
    """Dense TF-IDF rows of unit length."""
    out = np.zeros((n_rows, len(idf)), "f4")
    np.add.at(out, (row, term), 1)
    out = np.log1p(out) * idf.astype("f4")
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


WORDS = "doc_id long, key binary, n_words long, at binary, terms binary"


def item_words(docs: DataFrame, items: Items) -> DataFrame:
    """What the items' words do in every document (id, body): the only pass over the texts.

    Per document: a key of its text, its number of words, the places and numbers of those that items
    or answers use. No other word can make a passage similar or be in a common subsequence.
    """
    terms = {word.encode(): number for word, number in items.terms.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = terms.get
        for batch in batches:
            rows: list[list] = [[] for _ in range(3)]
            for value in batch.column("body"):
                words = word_bytes(value.as_py())
                found = np.fromiter(map(get, words, repeat(-1)), "i4", len(words))
                at = np.flatnonzero(found >= 0).astype("i4")
                for column, x in zip(rows, (len(words), at.tobytes(), found[at].tobytes()), strict=True):
                    column.append(x)
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))],
                names=["doc_id", "key", "n_words", "at", "terms"],
            )

    return staged(docs.select("doc_id", text_key(F.col("body")).alias("key"), "body").mapInArrow(tidy(run), WORDS), "item-words")


def different_texts(words: DataFrame) -> DataFrame:
    """`item_words` of each text once, however many copies it has."""
    first = words.groupBy("key").agg(F.first(F.struct("n_words", "at", "terms")).alias("text"))
    return staged(first.select("text.*"), "different-texts")


def document_counts(texts: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """Over all `different_texts`: how many there are, and how many hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(n_terms, "i8")
        for batch in batches:
            n += batch.num_rows
            for value in batch.column("terms"):
                own = np.unique(np.frombuffer(value.as_py(), "i4"))
                seen[own[own < n_terms]] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))], names=["term", "n"])

    counts = texts.select("terms").mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(n_terms)
    total = 0
    for term, n in counts:
        if term < 0:
            total = n
        else:
            df[term] = n
    return total, df


def _add_product(
    total: np.ndarray, at: np.ndarray, terms: np.ndarray, text: np.ndarray, lengths: np.ndarray, idf: np.ndarray, held: np.ndarray
) -> int:
    """Adds rows.T @ (rows @ held) to `total`, a row per stride of the texts; gives the number of strides.

    Only the terms that some strides use are multiplied, so the cost goes with the words, not with the number of terms.
    """
    spans = -(-lengths // STRIDE)
    known = terms < len(idf)
    known[known] = idf[terms[known]] > 0
    at, terms, text = at[known], terms[known], text[known]
    block = (np.cumsum(spans) - spans)[text] + at // STRIDE
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, "i8")
    ends = np.append(starts[1:], len(block))
    logs = np.log1p(np.arange(STRIDE + 1)).astype("f4")
    for low in range(0, len(starts), FIT_STRIDES):
        own = slice(starts[low], ends[min(low + FIT_STRIDES, len(starts)) - 1])
        sizes = (ends - starts)[low : low + FIT_STRIDES]
        row = np.repeat(np.arange(len(sizes)), sizes)
        used, place = np.unique(terms[own], return_inverse=True)
        counts = np.bincount(row * len(used) + place, minlength=len(sizes) * len(used))
        rows = logs[counts].reshape(len(sizes), len(used)) * idf[used].astype("f4")
        rows /= np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
        total[used] += rows.T @ (rows @ held[used])
    return int(spans.sum())


def fit_space(texts: DataFrame, items: Items, n_docs: int, df: np.ndarray, rank: int = RANK) -> Space:
    """Latent space of TF-IDF passages of all `different_texts`, by randomised subspace iteration.

    Each step multiplies the passages with the current basis. What a task returns is a matrix of
    terms x rank; FIT_TASKS tasks add these up, so that as many matrices reach the driver.
    """
    common = df > COMMON_SHARE * max(n_docs, 1)
    needed = np.zeros(len(df), bool)
    for own_words in items.words:
        own = np.unique(_term_rows(own_words, items.terms))
        if (~common[own]).sum() < LEAST_TERMS:
            needed[own] = True
    idf = np.where(common & ~needed, 0.0, np.log((1 + n_docs) / (1 + df)) + np.where(common, 0.1, 1.0))
    rank = min(rank, len(idf))
    row = np.repeat(np.arange(len(items.words)), [len(w) for w in items.words])
    term = np.concatenate([_term_rows(w, items.terms) for w in items.words]) if len(row) else np.zeros(0, "i8")
    own = _matrix(row, term, len(items.words), idf).astype("f8")
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((len(idf), rank)))[0]
    schema = "product binary, n long"

    def packed(total: np.ndarray, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.astype("f4").tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["product", "n"])

    for _ in range(POWER_STEPS):
        shape, held = basis.shape, basis.astype("f4")

        def multiply(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(held.shape), 0
            for batch in batches:
                for part in _portions(batch):
                    at = [np.frombuffer(v.as_py(), "i4") for v in part.column("at")]
                    terms = [np.frombuffer(v.as_py(), "i4") for v in part.column("terms")]
                    text = np.repeat(np.arange(len(at)), [len(p) for p in at])
                    lengths = part.column("n_words").to_numpy(zero_copy_only=False)
                    n += _add_product(total, np.concatenate(at), np.concatenate(terms), text, lengths, idf, held)
            yield packed(total, n)

        def add(batches: Iterator[pa.RecordBatch], shape=shape) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(shape), 0
            for batch in batches:
                for product, passages in zip(batch.column("product"), batch.column("n"), strict=True):
                    total += np.frombuffer(product.as_py(), "f4").reshape(shape)
                    n += passages.as_py()
            yield packed(total, n)

        parts = texts.mapInArrow(tidy(multiply), schema).repartition(FIT_TASKS).mapInArrow(tidy(add), schema).collect()
        product, passages = np.zeros(shape), 0
        for p in parts:
            product += np.frombuffer(bytes(p["product"]), "f4").reshape(shape)
            passages += p["n"]
        # The items weigh as much as all passages, so the space holds their directions.
        product += max(passages, 1) / max(len(own), 1) * (own.T @ (own @ basis))
        basis = np.linalg.qr(product)[0]
    latent = own @ basis
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return Space(idf, common, basis.astype("f4"), latent.astype("f4"))


def _run_sums(rows: np.ndarray, picked: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of `rows[picked]` over the runs that begin at `starts`: the k-th rows of all runs that have one are added at once."""
    sizes = np.diff(np.append(starts, len(picked)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[order], sizes[order]
    sums = rows[picked[first]]
    for k in range(1, int(sizes[0])):
        longer = int(np.searchsorted(-sizes, -k))
        sums[:longer] += rows[picked[first[:longer] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _candidates(
    at: np.ndarray, terms: np.ndarray, text: np.ndarray, lengths: np.ndarray, space: Space, weighted: np.ndarray, cosine: float
) -> Iterator[tuple[int, int, int, float]]:
    """(text, first word, item, cosine) of passages near an item.

    `terms` are the items' words of several texts, one text after the other, `at` their places in their `text`, of
    `lengths` words. A passage is three strides of words of one text; its vector is the sum of three vectors of strides.
    """
    # Two empty blocks behind each text keep passages of different texts apart.
    spans = -(-lengths // STRIDE) + 2
    bases = np.cumsum(spans) - spans
    known = terms < len(space.idf)
    known[known] = space.idf[terms[known]] > 0
    if not known.any():
        return
    at, terms, text = at[known], terms[known], text[known]
    block = bases[text] + at // STRIDE
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    blocks, owner = block[starts], text[starts]
    sums = np.zeros((int(spans.sum()) + 2, weighted.shape[1]), "f4")
    sums[blocks] = _run_sums(weighted, terms, starts)
    first = np.unique(np.concatenate([np.maximum(blocks - back, bases[owner]) for back in range(3)]))
    # A common passage may be near many items: only so many passages are compared at once.
    for low in range(0, len(first), PASSAGES):
        own = first[low : low + PASSAGES]
        vectors = sums[own] + sums[own + 1] + sums[own + 2]
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        cosines = vectors @ space.items.T
        cosines /= np.maximum(norms, 1e-12)[:, None]
        passages, items = np.nonzero(cosines >= cosine)
        texts = np.searchsorted(bases, own[passages], side="right") - 1
        words = (own[passages] - bases[texts]) * STRIDE
        yield from zip(texts.tolist(), words.tolist(), items.tolist(), cosines[passages, items].tolist(), strict=True)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    answer_col: str | None = None,
    cosine: float = COSINE,
    block_items: int = BLOCK_ITEMS,
    rank: int = RANK,
) -> DataFrame:
    """Pairs of a document and a benchmark item it contains, one row per pair.

    Returns the id column of `docs`, item_id, cosine, lcs (share of the item's words in the
    longest common subsequence with the passage), answer (the same for its answer, words in
    many documents left out) and kind: "verbatim" or "paraphrase". Repeated document rows
    give repeated rows.
    Null and empty texts, and items without words, match nothing; either table may be empty.
    """
    spark = docs.sparkSession
    bodies = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(text_col).alias("body"))
    answer = F.col(f"`{answer_col}`") if answer_col else F.lit(None).cast("string")
    schema = "doc_id long, item long, cosine double, lcs double, answer double, kind string"
    numbered = staged(
        items.select(F.col(f"`{item_id}`").alias("item_id"), whole_text(item_text).alias("text"), answer.alias("answer"))
        .repartition(1 + items.count() // block_items)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    found = None
    for block in _blocks(numbered, block_items):
        leaks = _leaks_of_block(bodies, block, cosine, rank, schema)
        found = leaks if found is None else found.unionByName(leaks)
    if found is None:
        found = spark.createDataFrame([], schema)
    named = found.join(numbered.select("item", "item_id"), "item")
    return named.select(F.col("doc_id").alias(id_col), "item_id", "cosine", "lcs", "answer", "kind")


def _blocks(numbered: DataFrame, size: int) -> Iterator[Items]:
    """The items, `size` at a time; never more than a block is in the driver."""
    ids, words, answers = [], [], []
    for row in numbered.toLocalIterator():
        own = words_in(row["text"].lower())
        if not own:
            continue
        ids.append(row["item"])
        words.append(own)
        answers.append(words_in(row["answer"].lower()) if row["answer"] else answer_words(row["text"]))
        if len(ids) == size:
            yield Items(ids, words, answers)
            ids, words, answers = [], [], []
    if ids:
        yield Items(ids, words, answers)


def _portions(batch: pa.RecordBatch, size: int = 160_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about so many bytes of places, a long text alone."""
    return portions(batch, pc.binary_length(batch.column("at")).to_numpy(zero_copy_only=False), size)


def _leaks_of_block(bodies: DataFrame, items: Items, cosine: float, rank: int, schema: str) -> DataFrame:
    words = item_words(bodies, items)
    texts = different_texts(words)
    n_docs, df = document_counts(texts, items.n_terms)
    space = fit_space(texts, items, n_docs, df, rank)
    longest = max(map(len, items.words))

    numbers = [[items.terms[w] for w in own] for own in items.words]

    def content(own: list[int]) -> list[int]:
        """Words that are not common among the documents; none if those are too few to tell a paraphrase by."""
        rare = [w for w in own if not space.common[w]]
        return rare if len(set(rare)) >= LEAST_TERMS else []

    inner = [content(own) for own in numbers]
    inner_answers = []
    for answer, own in zip(items.answers, inner, strict=True):
        held = set(own)
        inner_answers.append([n for w in answer if (n := items.terms[w]) in held or n >= items.n_terms] or own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = space.basis * space.idf[:, None].astype("f4")
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for part in _portions(batch):
                places = [np.frombuffer(v.as_py(), "i4") for v in part.column("at")]
                terms = [np.frombuffer(v.as_py(), "i4") for v in part.column("terms")]
                text = np.repeat(np.arange(len(places)), [len(p) for p in places])
                lengths = part.column("n_words").to_numpy(zero_copy_only=False)
                found = _candidates(np.concatenate(places), np.concatenate(terms), text, lengths, space, weighted, cosine)
                best: dict[tuple[int, int], tuple] = {}
                for t, start, i, near in found:
                    low, high = np.searchsorted(places[t], (start - longest, start + 3 * STRIDE + longest))
                    passage = terms[t][low:high].tolist()
                    item, around = numbers[i], set(passage)
                    # No subsequence is longer than the words both have.
                    if sum(w in around for w in item) < PARAPHRASE * len(item):
                        continue
                    lcs = lcs_length(item, passage) / len(item)
                    if lcs < PARAPHRASE:
                        continue
                    held = lcs_length(inner_answers[i], passage) / len(inner_answers[i]) if inner_answers[i] else 0.0
                    kind = "verbatim" if lcs >= VERBATIM else None
                    if not kind and inner[i] and held >= ANSWER and lcs_length(inner[i], passage) >= PARAPHRASE * len(inner[i]):
                        kind = "paraphrase"
                    if kind and ((t, i) not in best or (lcs, near) > best[t, i][1::-1]):
                        best[t, i] = (near, lcs, held, kind)
                docs = part.column("doc_id")
                for (t, i), values in best.items():
                    for column, x in zip(out, (docs[t].as_py(), items.ids[i], *values), strict=True):
                        column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["doc_id", "item", "cosine", "lcs", "answer", "kind"]
            )

    return words.select("doc_id", "n_words", "at", "terms").mapInArrow(tidy(run), schema)
