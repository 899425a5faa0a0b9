"""Conversations as training text, by any template, with each turn's span found from outside.

A template is a black box: a function from a list of (role, text) to a string. Successive prefixes of a
conversation are rendered; what a turn adds to the output is its span. A template that
changes what it wrote before is found by the outputs no longer growing at their end. The text within a span is
found by rendering the turn with two other texts, which differ only there.

A long conversation is rendered in blocks, each after its conversation's first turn and the last turns of the
block before. Turns at the seam are rendered in both blocks: if they differ there, the template looks
farther back, and the conversation is rendered whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import staged
from presslake.llm.places import placed

Template = Callable[[list[tuple[str, str]]], str]

#: Turns of a block, and turns before it that it is rendered after (besides the first of all).
BLOCK = 32
LAP = 2
#: Longest text that a template may keep moving to the end of its output.
LONGEST_TRAILER = 4096

# The control strings of common chat formats, none of which may stand in a text as it is.
CONTROL_STRINGS = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL_STRINGS))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """No control string stands in the result: each gets a backslash behind its first character; others are doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: Sequence[tuple[str, str]]) -> str:
    """The default template: every turn between its marks, whatever the roles and their order."""
    return "".join(f"<|im_start|>{escape(role).replace('\n', '\\\n')}\n{escape(text)}<|im_end|>\n" for role, text in turns)


def read_turn(turn: str) -> tuple[str, str]:
    """The role and text of one turn as `marked_turns` writes it."""
    found = _TURN.fullmatch(turn)
    if found is None:
        raise ValueError(f"not a turn: {turn[:80]!r}")
    return unescape(found[1]), unescape(found[2])


@dataclass
class Rendered:
    """Output for the turns after the context, their spans in it (start, end, loss_start, loss_end; None where
    unknown), the trailer that follows the last turn, the first turn at which earlier output changed, and what
    the last turn of context and the last of all have added."""

    output: str
    spans: list[tuple[int | None, int | None, int | None, int | None]]
    trailer: str
    rewritten_at: int | None
    seam_in: str
    seam_out: str


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def common_suffix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low]:
            low = mid
        else:
            high = mid - 1
    return low


def text_place(render: Template, before: list[tuple[str, str]], role: str, output: str) -> tuple[int, int] | None:
    """Where the last turn's text stands in `output`: between what two other texts have in common.

    None if `output` has not the same surroundings, that is if the template's marks depend on the text.
    """
    a, b = render([*before, (role, "x")]), render([*before, (role, "y")])
    head, foot = common_prefix(a, b), common_suffix(a, b)
    if head + foot >= len(a) or len(output) < head + foot:
        return None
    if output[:head] != a[:head] or output[len(output) - foot :] != a[len(a) - foot :]:
        return None
    return head, len(output) - foot


def locate(render: Template, turns: list[tuple[str, str]], context: int = 0, trained: Sequence[str] = ("assistant",)) -> Rendered:
    """Renders every prefix of `turns`; the first `context` turns are there for the others' sake."""
    output, ends, stable, tails, places = "", [], [], [], []
    for k in range(len(turns)):
        longer = render(turns[: k + 1])
        stable.append(common_prefix(output, longer) if k else 0)
        ends.append(len(longer))
        tails.append(longer[-LONGEST_TRAILER:])
        output = longer
        place = text_place(render, turns[:k], turns[k][0], longer) if k >= context and turns[k][0] in trained else None
        places.append(place)
    # What the output before had at its end and the next one has not at the same place.
    gone = [ends[k - 1] - stable[k] if k else 0 for k in range(len(turns))]
    moved = max(gone, default=0)
    rewritten_at = None
    if moved and (moved > LONGEST_TRAILER or len({tail[-moved:] for tail in tails}) > 1):
        rewritten_at, moved = next(k for k, g in enumerate(gone) if g), 0
    starts = [0, *(end - moved for end in ends[:-1])]
    base = starts[context] if context < len(turns) else 0
    spans = []
    for k in range(context, len(turns)):
        end = ends[k] - moved
        if rewritten_at is not None and end > min(stable[k + 1 :], default=end):
            spans.append((None, None, None, None))
            continue
        loss = (places[k][0] - base, places[k][1] - base) if places[k] else (None, None)
        spans.append((starts[k] - base, end - base, *loss))
    last = len(turns) - 1
    added = lambda k: output[starts[k] : ends[k] - moved] if k >= 0 else ""
    trailer = output[len(output) - moved :] if moved else ""
    return Rendered(output[base : len(output) - moved], spans, trailer, rewritten_at, added(context - 1), added(last))


BLOCKS = (
    "block long, n_blocks long, n_turns long, formatted string, rewritten_at long, error string, seam_in string, seam_out string, "
    "turns array<struct<place:long,role:string,start:long,end:long,loss_start:long,loss_end:long>>"
)
_CELLS = [
    ("block", pa.int64()), ("n_blocks", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("rewritten_at", pa.int64()), ("error", pa.string()), ("seam_in", pa.string()), ("seam_out", pa.string()),
    ("turns", pa.list_(pa.struct([
        ("place", pa.int64()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
        ("loss_start", pa.int64()), ("loss_end", pa.int64()),
    ]))),
]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            yield from batch.slice(i, 64).to_pylist()


def _render_blocks(rows: DataFrame, template: Template, trained: Sequence[str]) -> DataFrame:
    """One row per (conv, block) of `rows` (conv, block, n_blocks, n_turns, place, role, text); rows before the block's
    own, by `own`, are its context."""
    kind = rows.schema["conv"].dataType
    rows = rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "place")
    trained = tuple(trained)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def block_row(first: dict, group: list[dict]) -> dict:
            turns = [(r["role"] or "", r["text"] or "") for r in group]
            context = sum(not r["own"] for r in group)
            row = {"conv": first["conv"], "block": first["block"], "n_blocks": first["n_blocks"], "n_turns": first["n_turns"]}
            try:
                found = locate(template, turns, context, trained)
            except Exception as refused:  # a template may refuse a conversation
                return row | {"error": f"{type(refused).__name__}: {refused}", "turns": [], "seam_in": "", "seam_out": ""}
            # Of a conversation in blocks only the last has the trailer behind it.
            last = first["block"] == first["n_blocks"] - 1
            seam = lambda text: sha256((text + "\0" + found.trailer).encode()).hexdigest()
            keys = ("start", "end", "loss_start", "loss_end")
            spans = [
                {"place": r["place"], "role": r["role"] or ""} | dict(zip(keys, span))
                for r, span in zip(group[context:], found.spans)
            ]
            at = None if found.rewritten_at is None else group[found.rewritten_at]["place"]
            return row | {
                "formatted": found.output + (found.trailer if last else ""), "rewritten_at": at, "turns": spans,
                "seam_in": seam(found.seam_in) if context else "", "seam_out": seam(found.seam_out),
            }

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv").type
                yield batch

        for _, group in groupby(_rows(typed()), key=lambda r: (r["conv"], r["block"])):
            group = list(group)
            schema = pa.schema([("conv", id_type), *_CELLS])
            yield from pa.Table.from_pylist([block_row(group[0], group)], schema=schema).to_batches()

    schema = f"conv {kind.simpleString()}, {BLOCKS}"
    return rows.mapInArrow(render, schema)


def format_chat(
    chats: DataFrame,
    template: Template = marked_turns,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: Sequence[str] = ("assistant",),
    block: int = BLOCK,
) -> DataFrame:
    """Conversations rendered by `template`, one row per block of up to `block` turns: conv, block, n_blocks, n_turns,
    formatted, turns, rewritten_at, error.

    The blocks of a conversation, one after the other, are its text. `turns` has each turn's place, role, span in its
    block, and for trained roles the span of the text alone, which is what the loss is taken on. Spans are null where the
    template later changed the text; `rewritten_at` is the first turn at which it did. `error` is what a
    template said that refused the conversation; it then has no text.

    Turns are ordered by `turn` (null first), ties by role and text; a row that is there twice is two turns. Null
    roles and texts are empty, a null conversation is one of its own. An empty table has no rows. Other columns are
    ignored. A very long text is held, with a few renderings of its block, by one task. A conversation of several blocks is
    rendered whole, in one task, only if the template looks back farther than the seams of its blocks, or refuses or
    rewrites one of them.
    """
    rows = chats.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")
    )
    rows = placed(rows, ["conv"], ["turn", "role", "text"], ("place", "n_turns"))
    rows = staged(rows.withColumn("n_blocks", F.ceil(F.col("n_turns") / block).cast("long")), "turns")
    own = F.floor(F.col("place") / block).cast("long")
    # A turn goes to its own block, the last of a block to the next as well, the first of all to every one.
    near = F.when((F.col("place") % block >= block - LAP) & (own + 1 < F.col("n_blocks")), F.array(own, own + 1)).otherwise(F.array(own))
    every = F.when(F.col("place") == 0, F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).otherwise(near)
    dealt = rows.select("*", F.explode(every).alias("block")).withColumn("own", F.col("block") == own)
    blocks = staged(_render_blocks(dealt, template, trained), "blocks")
    several = blocks.filter("n_blocks > 1")
    outs = several.select("conv", (F.col("block") + 1).alias("block"), F.col("seam_out").alias("before"))
    seams = several.alias("b").join(outs.alias("a"), (F.col("b.conv").eqNullSafe(F.col("a.conv"))) & (F.col("b.block") == F.col("a.block")), "left")
    broken = (F.col("rewritten_at").isNotNull()) | F.col("error").isNotNull() | ((F.col("b.block") > 0) & (F.col("seam_in") != F.col("before")))
    far = staged(seams.filter(broken).select("b.conv").distinct(), "far")
    columns = [c for c in blocks.columns if c not in ("seam_in", "seam_out")]
    if not far.limit(1).count():
        return blocks.select(*columns)
    same = lambda left: left["conv"].eqNullSafe(far["conv"])
    whole = rows.join(far, same(rows), "left_semi").withColumns(
        {"n_blocks": F.lit(1).cast("long"), "block": F.lit(0).cast("long"), "own": F.lit(True)}
    )
    again = staged(_render_blocks(whole, template, trained), "whole")
    return blocks.join(far, same(blocks), "left_anti").select(*columns).unionByName(again.select(*columns))


def chat_digests(blocks: DataFrame, read: Callable[[str], tuple[str, str]] = read_turn, plain: Callable[[str], str] = unescape) -> DataFrame:
    """Per conversation, read back from its text: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest runs over all turns in order, so the blocks of a conversation pass through one task, one
    at a time; only the states of two digests are held. Conversations of one block are not shuffled.
    """
    kind = blocks.schema["conv"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv").type
                yield batch

        out: list[dict] = []
        for conv, group in groupby(_rows(typed()), key=lambda r: r["conv"]):
            turns, loss = sha256(), sha256()
            row = {"conv": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
            for block in group:
                shown = block["formatted"] or ""
                row["formatted_chars"] += len(shown)
                for t in block["turns"]:
                    if t["start"] is None:
                        continue
                    role, text = read(shown[t["start"] : t["end"]])
                    turns.update(f"{role}\n{text}\n".encode())
                    row["n_turns"] += 1
                    if t["loss_start"] is not None:
                        trained = plain(shown[t["loss_start"] : t["loss_end"]])
                        loss.update(trained.encode())
                        row["loss_chars"] += len(trained)
            out.append(row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()})
            if len(out) == 1024:
                yield from _digest_batch(out, id_type)
                out = []
        if out:
            yield from _digest_batch(out, id_type)

    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    one, several = blocks.filter("n_blocks = 1"), blocks.filter("n_blocks > 1")
    several = several.repartition("conv").sortWithinPartitions("conv", "block")
    return one.mapInArrow(digest, schema).unionByName(several.mapInArrow(digest, schema))


def _digest_batch(rows: list[dict], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    fields = [
        ("conv", id_type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
    yield from pa.Table.from_pylist(rows, schema=pa.schema(fields)).to_batches()
