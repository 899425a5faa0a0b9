"""Quality by the perplexity of an interpolated modified Kneser-Ney bigram model.

The model is counted on trusted texts and gives every text a perplexity; per language a
quantile of the perplexities of trusted texts kept out of the counting is the limit.

Tokens (words as they are written, digits, runs of marks) have ids of 20 bits, so
what is kept by token has a fixed size. Pairs of tokens have no bound; their counts
stay in shards and are never gathered. A pair (v, w) belongs to a cell of a grid: the
upper bits of v and of w name the shard, the lower bits stand for it there in four
bytes. The counts of a trusted chunk of texts and the pairs of the texts to be scored
are dealt to the same shards and met there (a sharded count join).

A pair without a count only needs what is kept by token. Each shard leaves a bit set of
its pairs, of a fixed size for all shards together, so that nearly only counted pairs are
dealt out when texts are scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import staged, whole_text

TOKEN_BITS = 20
#: The grid has 2**GRID_BITS rows and columns of shards. More for more data.
GRID_BITS = 4
#: Bits of all shards' sets together.
SEEN_BITS = 28
#: Tokens of the texts that are dealt out in one go.
CHUNK_TOKENS = 2_000_000
#: Share of the trusted texts that is not counted but sets the limits.
HELD_OUT = 5
QUANTILE = 0.999

_find = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+").findall
_START = 0
#: Log chances are summed as integers of this many parts of a nat: exact in any order, and short.
PARTS = 1 << 20


class TokenIds(dict):
    """Token -> id of TOKEN_BITS bits; forgets all when it has grown large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[token] = out = 1 + zlib.crc32(token.encode("utf-8", "surrogatepass")) % ((1 << TOKEN_BITS) - 1)
        return out


def pairs_of(texts: list[str], ids: TokenIds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all tokens, of the token before each (a start mark at the beginning), and tokens per text."""
    lists = [list(map(ids.__getitem__, _find(t))) for t in texts]
    lengths = np.array([len(x) for x in lists], "i8")
    word = np.array([i for x in lists for i in x], "i4")
    before = np.empty_like(word)
    before[1:] = word[:-1]
    starts = np.cumsum(lengths) - lengths
    before[starts[lengths > 0]] = _START
    return word, before, lengths


def _cells(before: np.ndarray, word: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and code of each pair."""
    low = TOKEN_BITS - grid
    before, word, mask = before.astype("u4"), word.astype("u4"), np.uint32((1 << low) - 1)
    return (((before >> low) << grid) | (word >> low)).astype("i4"), ((before & mask) << low) | (word & mask)


def pack_sorted(codes: np.ndarray) -> bytes:
    """Rising codes as compressed differences, the bytes of equal weight together."""
    steps = np.diff(codes, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(np.ascontiguousarray(steps.view("u1").reshape(-1, 4).T).tobytes(), 1)


def unpack_sorted(packed) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), "u1").reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype="u4")


def _tokens(shard: int, codes: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (before, word) of a shard's codes."""
    low = TOKEN_BITS - grid
    before = ((shard >> grid) << low) | (codes.astype("i8") >> low)
    return before, ((shard & ((1 << grid) - 1)) << low) | (codes.astype("i8") & ((1 << low) - 1))


def _seen_places(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype("i4")


def _split(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places of its pairs, in their order."""
    order = np.argsort(shards, kind="stable")
    ordered = shards[order]
    cuts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=False):
        yield int(ordered[a]), order[a:b]


def _chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about CHUNK_TOKENS tokens of text (by their bytes)."""
    held, size = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            held.append(part)
            size += part.column(text).nbytes
            if size > CHUNK_TOKENS * 6:
                yield held
                held, size = [], 0
    if held:
        yield held


def count_pairs(texts: DataFrame, grid: int = GRID_BITS) -> DataFrame:
    """For texts (body): per shard the sorted codes of its pairs, their counts, and the set of pairs.

    Counted per chunk before the shuffle, so a frequent pair is one entry per chunk.
    """
    seen_bits = SEEN_BITS - 2 * grid

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = TokenIds()
        for chunk in _chunks(batches, "body"):
            word, before, _ = pairs_of([t for part in chunk for t in part.column("body").to_pylist()], ids)
            keys, counts = np.unique((before.astype("i8") << TOKEN_BITS) | word, return_counts=True)
            shards, codes = _cells(keys >> TOKEN_BITS, keys & ((1 << TOKEN_BITS) - 1), grid)
            # The keys rise, and so do the codes of each shard.
            rows = [
                {"shard": s, "codes": pack_sorted(codes[at]), "counts": zlib.compress(counts[at].astype("u4").tobytes(), 1)}
                for s, at in _split(shards)
            ]
            schema = pa.schema([("shard", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])
            yield pa.RecordBatch.from_pylist(rows, schema)

    def merge(table: pa.Table) -> pa.Table:
        codes = np.concatenate([unpack_sorted(x.as_buffer()) for x in table.column("codes")])
        counts = np.concatenate([np.frombuffer(zlib.decompress(x.as_buffer()), "u4") for x in table.column("counts")])
        own, where = np.unique(codes, return_inverse=True)
        sums = np.bincount(where, weights=counts).astype("u4")
        seen = np.zeros(1 << seen_bits, bool)
        seen[_seen_places(own, seen_bits)] = True
        return pa.table(
            {
                "shard": table.column("shard").slice(0, 1),
                "codes": pa.array([pack_sorted(own)], pa.binary()),
                "counts": pa.array([zlib.compress(sums.tobytes(), 1)], pa.binary()),
                "seen": pa.array([np.packbits(seen).tobytes()], pa.binary()),
            }
        )

    packs = texts.select("body").mapInArrow(run, "shard int, codes binary, counts binary")
    return staged(packs.groupBy("shard").applyInArrow(merge, "shard int, codes binary, counts binary, seen binary"), "pair-counts")


@dataclass
class Model:
    """What is kept by token, and the discounts. All arrays have a fixed size."""

    total: np.ndarray  # count of the token as the first of a pair
    left: np.ndarray  # share of it that its discounts leave to the lower order
    lower: np.ndarray  # continuation probability of the token
    discounts: np.ndarray  # by count 0, 1, 2, 3 and more
    seen: np.ndarray  # packed bits by shard
    grid: int


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts from the numbers of pairs that occur 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (max(float(x), 1.0) for x in n)
    y = n1 / (n1 + 2 * n2)
    return np.clip([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.1, 0.2, 0.3], [0, 1, 2, 3])


def model_of(counts: DataFrame, grid: int = GRID_BITS) -> Model:
    """Sum the counts by token. At most 2**TOKEN_BITS narrow rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, codes, n in zip(*(batch.column(c) for c in ("shard", "codes", "counts")), strict=True):
                n = np.frombuffer(zlib.decompress(n.as_buffer()), "u4").astype("i8")
                before, word = _tokens(shard.as_py(), unpack_sorted(codes.as_buffer()), grid)
                first, at = np.unique(before, return_inverse=True)
                last, follows = np.unique(word, return_counts=True)
                zeros = np.zeros(len(last) + 1, "i8")
                by = lambda use: np.bincount(at, weights=use, minlength=len(first)).astype("i8")  # noqa: B023, E731
                columns = {
                    "token": np.concatenate([first, last, [-1]]),
                    "total": np.concatenate([by(n), zeros[:-1], [(n == 4).sum()]]),
                    **{f"n{k}": np.concatenate([by(n == k if k < 3 else n > 2), zeros[:-1], [(n == k).sum()]]) for k in (1, 2, 3)},
                    "follows": np.concatenate([np.zeros(len(first), "i8"), follows, [0]]),
                }
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})

    names = ["total", "n1", "n2", "n3", "follows"]
    rows = counts.select("shard", "codes", "counts").mapInArrow(run, "token long, " + ", ".join(f"{c} long" for c in names))
    table = rows.groupBy("token").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    token = table.column("token").to_numpy()
    size = 1 << TOKEN_BITS
    total, n1, n2, n3, follows = (np.zeros(size) for _ in names)
    real = token >= 0
    for target, name in zip((total, n1, n2, n3, follows), names, strict=True):
        target[token[real]] = table.column(name).to_numpy()[real]
    whole = [table.column(c).to_numpy()[~real].sum() for c in ("n1", "n2", "n3", "total")]
    discounts = _discounts(np.array(whole))
    left = np.where(total > 0, (discounts[1] * n1 + discounts[2] * n2 + discounts[3] * n3) / np.maximum(total, 1), 1.0)
    # The lower order is interpolated with equal chances for all ids.
    kinds = max(follows.sum(), 1.0)
    low = _discounts(np.array([(follows == k).sum() for k in (1, 2, 3, 4)]))
    cut = low[np.minimum(follows, 3).astype("i8")]
    lower = np.maximum(follows - cut, 0) / kinds + (np.minimum(cut, follows).sum() / kinds if follows.any() else 1.0) / size
    seen = np.zeros((1 << 2 * grid, 1 << (SEEN_BITS - 2 * grid - 3)), "u1")
    # The bit sets: 2**SEEN_BITS bits for all shards together.
    for row in counts.select("shard", "seen").toLocalIterator():
        seen[row["shard"]] = np.frombuffer(bytes(row["seen"]), "u1")
    return Model(total.astype("f4"), left.astype("f4"), lower.astype("f4"), discounts, seen, grid)


def score(texts: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """For texts (row, body) with rows numbered on within each partition: row, tokens and log_p (natural log of its chance)."""
    in_parts = lambda logs: np.rint(logs * PARTS).astype("i8")
    held = texts.sparkSession.sparkContext.broadcast(model)
    grid, seen_bits = model.grid, SEEN_BITS - 2 * model.grid
    fields = "shard long, codes binary, owners binary, sums binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, ids = held.value, TokenIds()
        for n_chunk, chunk in enumerate(_chunks(batches, "body")):
            rows = np.concatenate([part.column("row").to_numpy() for part in chunk])
            word, before, lengths = pairs_of([t for part in chunk for t in part.column("body").to_pylist()], ids)
            owner = np.repeat(np.arange(len(rows), dtype="i4"), lengths)
            chance = np.log(m.left[before] * m.lower[word])
            sums = np.bincount(owner, weights=chance, minlength=len(rows))
            # The sums of a chunk go to a group of their own, named by a negative number.
            name = -1 - ((TaskContext.get().partitionId() << 24) | n_chunk)
            out = [{"shard": name, "codes": b"", "owners": rows.astype("i8").tobytes(), "sums": np.stack([lengths, sums]).astype("f8").tobytes()}]
            shards, codes = _cells(before, word, grid)
            place = _seen_places(codes, seen_bits)
            known = (m.seen[shards, place >> 3] >> (7 - (place & 7)).astype("u1")) & 1 > 0
            shards, codes, owner = shards[known], codes[known], owner[known]
            for s, at in _split(shards):
                # Pairs stand in the order of their texts: how many each text has tells whose they are.
                per_text = np.bincount(owner[at] - owner[at[0]]).astype("u4")
                packed = zlib.compress(per_text.astype("u1" if per_text.max() < 256 else "u4").tobytes(), 1)
                out.append({"shard": s, "codes": codes[at].tobytes(), "owners": rows[owner[at[:1]]].astype("i8").tobytes(), "sums": packed})
            schema = pa.schema([("shard", pa.int64()), ("codes", pa.binary()), ("owners", pa.binary()), ("sums", pa.binary())])
            yield pa.RecordBatch.from_pylist(out, schema)

    def meet(table: pa.Table, packs: pa.Table) -> pa.Table:
        none = pa.table({name: pa.array([], pa.int64()) for name in ("row", "tokens", "log_p")})
        if not packs.num_rows:
            return none
        shard = packs.column("shard")[0].as_py()
        rows, tokens, logs = [], [], []
        if shard < 0:
            for owners, sums in zip(packs.column("owners"), packs.column("sums"), strict=True):
                both = np.frombuffer(sums.as_buffer(), "f8").reshape(2, -1)
                rows.append(np.frombuffer(owners.as_buffer(), "i8"))
                tokens.append(both[0].astype("i8"))
                logs.append(in_parts(both[1]))
        elif table.num_rows:
            m = held.value
            own = unpack_sorted(table.column("codes")[0].as_buffer())
            n = np.frombuffer(zlib.decompress(table.column("counts")[0].as_buffer()), "u4")
            for codes, owners, sums in zip(*(packs.column(c) for c in ("codes", "owners", "sums")), strict=True):
                codes = np.frombuffer(codes.as_buffer(), "u4")
                raw = zlib.decompress(sums.as_buffer())
                first = np.frombuffer(owners.as_buffer(), "i8")[0]
                per = np.frombuffer(raw, "u1")
                if per.sum() != len(codes):
                    per = np.frombuffer(raw, "u4")
                owner = np.repeat(np.arange(len(per)), per)
                at = np.minimum(np.searchsorted(own, codes), len(own) - 1)
                hit = own[at] == codes
                codes, owner, count = codes[hit], owner[hit], n[at[hit]].astype("f8")
                before, word = _tokens(shard, codes, grid)
                rest = m.left[before].astype("f8") * m.lower[word]
                gain = np.log1p((count - m.discounts[np.minimum(count, 3).astype("i8")]) / m.total[before] / rest)
                sums = np.bincount(owner, weights=gain, minlength=len(per))
                some = np.flatnonzero(sums)
                rows.append(first + some)
                tokens.append(np.zeros(len(some), "i8"))
                logs.append(in_parts(sums[some]))
        if not rows:
            return none
        return pa.table({"row": pa.array(np.concatenate(rows)), "tokens": pa.array(np.concatenate(tokens)), "log_p": pa.array(np.concatenate(logs))})

    packs = texts.select("row", "body").mapInArrow(deal, fields)
    table = counts.select(F.col("shard").cast("long").alias("shard"), "codes", "counts")
    met = table.groupBy("shard").cogroup(packs.groupBy("shard")).applyInArrow(meet, "row long, tokens long, log_p long")
    return met.groupBy("row").agg(F.sum("tokens").alias("tokens"), (F.sum("log_p") / PARTS).alias("log_p"))


def judge_quality(
    df: DataFrame,
    trusted: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    lang_col: str = "lang",
    quantile: float = QUANTILE,
    grid: int = GRID_BITS,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """Every row's perplexity and whether it is kept: id, lang, n_tokens, perplexity, limit, kept.

    `trusted` holds the ids of trusted rows. One in HELD_OUT of them, by the hash of the id, is
    not counted; per language the quantile of their perplexities is the limit, in languages
    without any (a null language is one of its own) that over all of them. A row is kept when
    its perplexity is at most the limit. Texts without tokens (null, empty) have no
    perplexity and are not kept. Without trusted rows nothing is known and
    every row with tokens is kept. Repeated rows are judged alike; an empty table gives
    an empty table.
    """
    ids = trusted.select(F.col(f"`{id_col}`").alias("trusted_id")).dropna().distinct()
    if ids.count() <= broadcast_rows:
        ids = F.broadcast(ids)
    base = df.select(
        F.col(f"`{id_col}`").alias("doc"), F.col(f"`{lang_col}`").alias("lang"), whole_text(text_col).alias("body"), F.monotonically_increasing_id().alias("row")
    )
    flagged = base.join(ids, F.col("doc") == F.col("trusted_id"), "left")
    held_out = F.pmod(F.xxhash64("trusted_id"), F.lit(HELD_OUT)) == 0
    counts = count_pairs(flagged.filter(F.col("trusted_id").isNotNull() & ~held_out), grid)
    model = model_of(counts, grid)
    perplexity = F.when(F.col("tokens") > 0, F.exp(-F.col("log_p") / F.col("tokens")))
    scored = score(base, counts, model).select("row", "tokens", perplexity.alias("perplexity"))
    facts = flagged.select("row", "doc", "lang", (F.col("trusted_id").isNotNull() & held_out).alias("sets_limit"))
    judged = staged(facts.join(scored, "row", "left"), "perplexities")
    known = judged.filter("sets_limit and perplexity is not null")
    limits = known.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("own_limit"))
    overall = known.agg(F.percentile_approx("perplexity", quantile, 10_000)).first()[0]
    limits = limits.select(F.col("lang").alias("limit_lang"), "own_limit")
    joined = judged.join(limits, F.col("lang").eqNullSafe(F.col("limit_lang")), "left")
    limit = F.coalesce("own_limit", F.lit(overall).cast("double"), F.lit(float("inf")))
    return joined.select(
        F.col("doc").alias(id_col),
        F.col("lang").alias(lang_col),
        F.coalesce("tokens", F.lit(0)).alias("n_tokens"),
        "perplexity",
        limit.alias("limit"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"),
    )
