"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (the parser below is its deterministic automaton)::

    conversation := turn*
    turn         := "<s>[INST] " field " [/INST] " field "</s>"        role, text
    field        := any characters, without an unescaped control string

A control string is ``<s>``, ``</s>``, ``[INST]`` or ``[/INST]``. With one or more ESC (U+001B) behind its first
character it is escaped; the parser takes one ESC away. A turn is rendered plainly first; if the parser does not
give back its role and text, the conflicting field is escaped: each control string in it, escaped or not, gets
one ESC more. This repeats until the turn is identical. A turn's rendering begins and ends with control strings
that no field holds unescaped, so the parse of a conversation is the parses of its turns, in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type_names

ESC = "\x1b"
#: Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
_CONTROL = re.compile(r"([<\[])(\x1b*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\x1b(\x1b*/?(?:s>|INST\]))")
_BARE = re.compile(r"</?s>|\[/?INST\]")


def escape(field: str) -> str:
    """One ESC more in every control string."""
    return _CONTROL.sub(lambda m: m[1] + ESC + m[2] + m[3], field)


def unescape(field: str) -> str:
    """The inverse of ``escape``."""
    return _ESCAPED.sub(r"\1\2", field)


class ParseError(ValueError):
    """The text is no sentence of the grammar."""


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns of a formatted text: role, text, and the span of the text's field in ``rendered``."""
    turns, at = [], 0
    while at < len(rendered):
        fields = []
        for lead, stop in ((OPEN, MIDDLE), ("", CLOSE)):
            if not rendered.startswith(lead, at):
                raise ParseError(f"expected {lead!r} at {at}")
            at += len(lead)
            m = _BARE.search(rendered, at)
            end = m.start() if m else -1
            if stop == MIDDLE:
                end -= 1
            if not m or end < at or not rendered.startswith(stop, end):
                raise ParseError(f"expected {stop!r} after {at}")
            fields.append((unescape(rendered[at:end]), at, end))
            at = end + len(stop)
        turns.append((fields[0][0], *fields[1]))
    return turns


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The rendering of one turn and how many escaping rounds it took."""
    r, t = role, text
    for rounds in range(8):
        out = f"{OPEN}{r}{MIDDLE}{t}{CLOSE}"
        try:
            got = parse(out)
            if len(got) == 1 and got[0][:2] == (role, text):
                return out, rounds
            bad = (len(got) != 1 or got[0][0] != role, len(got) != 1 or got[0][1] != text)
        except ParseError:
            bad = (bool(_CONTROL.search(role)), bool(_CONTROL.search(text)))
        r, t = escape(role) if bad[0] else r, escape(text) if bad[1] else t
    raise ParseError("escaping does not settle")


def format_turns(df: DataFrame) -> DataFrame:
    """Each row (conv_id, turn, role, text) with its ``rendered`` turn, what a parser reads back from it
    (``parsed_role``, ``parsed_text``), the span of the loss mask in it (``loss_from``, ``loss_to``: code points;
    empty but for assistants) and ``rounds`` of escaping.

    Null role or text is empty. Columns with those output names are replaced. Rows are independent: any
    length of conversation, and any number of equal rows, spreads over all tasks. An empty table gives no rows.
    """
    out = ("rendered", "parsed_role", "parsed_text", "loss_from", "loss_to", "rounds")
    df = df.drop(*out)
    schema = arrow_type_names(df) + ", rendered string, parsed_role string, parsed_text string, loss_from int, loss_to int, rounds int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {k: [] for k in out}
            for role, text in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                rendered, rounds = render_turn(role or "", text or "")
                ((got_role, got_text, lo, hi),) = parse(rendered)
                hi = hi if got_role == "assistant" else lo
                for k, v in zip(out, (rendered, got_role, got_text, lo, hi, rounds), strict=True):
                    cols[k].append(v)
            new = [pa.array(cols[k], pa.string() if k in out[:3] else pa.int32()) for k in out]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *out])

    return df.mapInArrow(run, schema)


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id of ``format_turns``' rows, in order of (turn, role, text): number of turns, digests of
    what is read back and of the loss mask, and the formatted length.

    The digests are chains over a conversation's turns, so its rows pass through one task, in order and one
    batch at a time: memory does not grow with a conversation. A null conv_id is a conversation of its own. An empty table gives no rows.
    """
    schema = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, key, began = None, None, False
        done: list[tuple] = []

        def close() -> None:
            if began:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in frames:
            for conv, rendered, lo, hi in zip(*(b.column(c).to_pylist() for c in ("conv_id", "rendered", "loss_from", "loss_to")), strict=True):
                if not began or conv != key:
                    close()
                    key, began, state = conv, True, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(rendered):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(rendered[lo:hi])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(rendered)
            if done:
                yield _frame(done, b.schema.field("conv_id").type)
                done = []
        close()
        if done:
            yield _frame(done, pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64())

    turns = turns.select("conv_id", "turn", "role", "text", "rendered", "loss_from", "loss_to")
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "rendered", "loss_from", "loss_to").mapInArrow(run, schema)


def _frame(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    kinds = (key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query: all conversations and the fixed conversation -7, which stays apart from one of that id in the table."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    fixed = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", fixed), (-7, 1, "assistant", fixed)], rows.schema)
    return conversations(format_turns(rows)).unionByName(conversations(format_turns(extra)))
