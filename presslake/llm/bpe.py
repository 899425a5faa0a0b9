"""Byte-level BPE by monoid tree reduction.

Encodings form a monoid under "join": the encoding of a concatenation depends on
its parts only near the place where they meet. A piece is cut in halves down to
short leaves, leaves are merged directly, and neighbours are joined by encoding a
window around the seam anew. The window doubles until its first and last token
are the tokens that stood there before. A token sequence is the encoding of its
bytes exactly when every two adjacent tokens encode to themselves (merges never
cross a border in the pair, so they never cross it in the whole), so from then
on everything outside the window is final.

Decoding joins the bytes of halves up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.llm.common import tidy, whole_text

LEAF_BYTES = 16
#: Windows up to this length are merged by looking through all pairs.
SHORT_BYTES = 128
#: Distinct pieces a worker remembers, and their longest; beyond that many it starts anew.
CACHE_PIECES = 300_000
CACHED_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 token and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Pieces(dict):
    """Match of the pattern -> its ids as little-endian unsigned 32-bit integers; encodes what it lacks."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class TreeBpe:
    """Encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.pieces = Pieces(self.piece)

    def merge(self, data: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost first, until none is left."""
        if len(data) > SHORT_BYTES:
            return self.merge_long(data)
        rank, none = self.ranks.get, 1 << 62
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            # Only the pairs beside the merged one have changed.
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return [self.ranks[part] for part in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """`merge` for long windows: pairs wait in a heap, parts are linked to their neighbours."""
        rank, n = self.ranks.get, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            # A part that was taken in has no end; a pair counts if its two parts still reach as far.
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := rank(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts from the encodings of each."""
        if not left or not right:
            return left or right
        width = 1
        while True:
            a, b = min(width, len(left)), min(width, len(right))
            seam = self.merge(self.decode(left[-a:]) + self.decode(right[:b]))
            first_holds = a == len(left) or seam[0] == left[-a]
            last_holds = b == len(right) or seam[-1] == right[b - 1]
            if first_holds and last_holds:
                return left[:-a] + seam + right[b:]
            width *= 2

    def reduce(self, data: bytes) -> list[int]:
        """Encode halves recursively and join them."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        # The left half has a power of two of leaves: in runs of one character its tokens, whose lengths are
        # powers of two as well, end where it ends, and no seam has to be moved.
        half = LEAF_BYTES << (((len(data) - 1) // LEAF_BYTES).bit_length() - 1)
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def piece(self, piece: str) -> list[int]:
        """One match of the pattern; a match that is a token as a whole is that token."""
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.reduce(data)

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as bytes. Tokens never cross matches, so matches just follow each other."""
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a token sequence, halves joined up the tree."""
        if len(ids) > 1 << 16:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> TreeBpe:
    return TreeBpe(read_ranks(path), pattern)


def encode_table(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id", keep_ids: bool = True
) -> DataFrame:
    """Token ids and the decoded bytes' digest of every text.

    Returns the id column, n_tokens, ids_sha256 (over the ids as little-endian unsigned
    32-bit integers), decoded_sha256, and ids when `keep_ids`. A null text is an empty
    one: no tokens and the digests of no bytes. Repeated rows give repeated rows, an
    empty table gives an empty one. `path` names the vocabulary on every machine.
    """
    fields = "row_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    narrow = df.select(F.col(f"`{id_col}`").cast("long").alias("row_id"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(path, pattern)
        for batch in batches:
            counts, ids_sha, bytes_sha, all_ids = [], [], [], []
            for value in batch.column("text"):
                packed = bpe.packed(value.as_py())
                ids = np.frombuffer(packed, "<u4")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                bytes_sha.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
                if keep_ids:
                    all_ids.append(ids.astype("int32"))
            columns = [batch.column("row_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())]
            names = ["row_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return narrow.mapInArrow(tidy(run), fields).withColumnRenamed("row_id", id_col)


def decode_column(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of an array of token ids; null for null."""

    @F.pandas_udf(T.BinaryType())
    def decoded(values):
        bpe = _encoder(path, pattern)
        return values.map(lambda v: None if v is None else bpe.decode([int(i) for i in v]))

    return decoded(ids)
