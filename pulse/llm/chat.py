"""Conversations as token ids: segments encoded apart, reserved ids spliced in, masks by prefix sums.

A turn is written as ``<|im_start|>role\\ncontent<|im_end|>\\n``. The two markers are single reserved
ids above the vocabulary; role, line feed and content are encoded as segments of their own, so no
token crosses a boundary and no text can produce a marker id. Control strings inside texts are
escaped as well, so that the rendered text is unambiguous too: after ``<`` and any backslashes
a ``|`` gets one more backslash before it. Unescaping takes one away. Backslashes and line feeds
in role names are escaped so that a role ends at the first line feed.

Turns are encoded row by row, wherever they lie. Places in the conversation and its loss mask follow
from prefix sums of segment lengths, a running window per conversation. Reading back streams the
turns of a conversation in order, so no conversation is held in one piece.

Defined results: null text or role is empty; only the role ``assistant`` is under the loss mask;
turns are ordered by turn (nulls first), then role, then text; repeated rows are turns of their own;
null conv_id is one conversation; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

TURNS = "conv_id long, turn long, role string, text string"
ENCODED = f"{TURNS}, ids array<int>, n_before_text long, n_text long, n_chars long"
READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long, n_loss_tokens long"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = re.compile(r"\\(.)", re.S)
    return plain.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """The vocabulary with two reserved ids above it."""

    def __init__(self, vocabulary: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.start = self.tokenizer.get_vocab_size()
        self.end = self.start + 1
        self.line = self.encode(["\n"])[0]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def turn(self, ids: list[int]) -> tuple[str, str]:
        """(role, content) as rendered, from the ids of one turn."""
        if ids[0] != self.start or ids[len(ids) - len(self.line) - 1] != self.end:
            raise ValueError("not a turn")
        role, _, text = self.decode(ids[1 : len(ids) - len(self.line) - 1]).partition("\n")
        return role, text


_TEMPLATES: dict[str, Template] = {}


def template(vocabulary: str) -> Template:
    if vocabulary not in _TEMPLATES:
        _TEMPLATES[vocabulary] = Template(vocabulary)
    return _TEMPLATES[vocabulary]


def _key(name: str) -> Column:
    return F.col(name).asc_nulls_first()


def format_turns(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """One row per turn: its ids, and its place and loss span in the whole conversation.

    Columns conv_id, turn_index, ids, at (ids of the conversation before the turn), loss_from and
    loss_to (ids under the mask, as places in the conversation; equal where none), n_chars.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(vocabulary)
        for batch in batches:
            roles = [r or "" for r in batch.column(2).to_pylist()]
            texts = [t or "" for t in batch.column(3).to_pylist()]
            shown = [(escape_role(r), escape(t)) for r, t in zip(roles, texts, strict=True)]
            heads = form.encode([r for r, _ in shown])
            bodies = form.encode([t for _, t in shown])
            ids = [
                [form.start, *h, *form.line, *b, form.end, *form.line]
                for h, b in zip(heads, bodies, strict=True)
            ]
            chars = [len(START) + len(r) + 1 + len(t) + len(END) + 1 for r, t in shown]
            lead = 1 + len(form.line)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([lead + len(h) for h in heads], pa.int64()),
                    pa.array([len(b) for b in bodies], pa.int64()),
                    pa.array(chars, pa.int64()),
                ],
                ["conv_id", "turn", "role", "text", "ids", "n_before_text", "n_text", "n_chars"],
            )

    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    encoded = rows.mapInArrow(run, ENCODED)
    order = Window.partitionBy("conv_id").orderBy(_key("turn"), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.size("ids").cast("long")
    placed = encoded.withColumn("turn_index", F.row_number().over(order)).withColumn(
        "at", F.sum(size).over(upto) - size
    )
    first = F.col("at") + F.col("n_before_text")
    learnt = F.when(F.col("role") == LOSS_ROLE, F.col("n_text")).otherwise(F.lit(0))
    return placed.select(
        "conv_id", "turn_index", "ids", "at", first.alias("loss_from"),
        (first + learnt).alias("loss_to"), "n_chars",
    )


def loss_mask(ids: Column, at: Column, loss_from: Column, loss_to: Column) -> Column:
    """0 or 1 for every id of a turn."""
    places = F.sequence(at, at + F.size(ids) - 1)
    return F.transform(places, lambda p: ((p >= loss_from) & (p < loss_to)).cast("tinyint"))


def read_back(turns: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of every conversation, from the ids alone, streamed turn by turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, state, open_ = template(vocabulary), None, False
        conv = None

        def begin():
            return {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0,
                    "chars": 0, "ids": 0, "loss_ids": 0}

        def row():
            return (conv, state["turns"], state["all"].hexdigest(), state["loss_chars"],
                    state["loss"].hexdigest(), state["chars"], state["ids"], state["loss_ids"])

        def out(rows):
            fields = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(fields)],
                [x.split()[0] for x in READ_BACK.split(", ")],
            )

        for batch in batches:
            rows = []
            names = ("conv_id", "ids", "at", "loss_from", "loss_to")
            for cid, ids, at, a, b in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if not open_ or cid != conv:
                    if open_:
                        rows.append(row())
                    conv, state, open_ = cid, begin(), True
                role, text = form.turn(ids)
                state["turns"] += 1
                state["ids"] += len(ids)
                state["chars"] += len(START) + len(role) + 1 + len(text) + len(END) + 1
                state["all"].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                if b > a:
                    learnt = unescape(form.decode(ids[a - at : b - at]))
                    state["loss"].update(learnt.encode())
                    state["loss_chars"] += len(learnt)
                    state["loss_ids"] += b - a
            if rows:
                yield out(rows)
        if open_:
            yield out([row()])

    dealt = turns.repartition("conv_id").sortWithinPartitions(_key("conv_id"), "turn_index")
    return dealt.select("conv_id", "ids", "at", "loss_from", "loss_to").mapInArrow(run, READ_BACK)
