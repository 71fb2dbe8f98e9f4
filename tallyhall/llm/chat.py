"""Chat texts rebuilt from event logs and rendered by a template with a loss mask.

Events carry a conversation, the message they belong to, its place, a step within it, and a kind:
  start       a message of `role` begins (again, if it has begun: the old content goes)
  delta       `text` is appended
  edit        `text` replaces what the message holds
  regenerate  what the message holds is thrown away; deltas that follow are the new answer
A log is dealt out by conversation and sorted by message and step in Spark, which spills, so that
an event that comes late reaches its own message; a task then reads it as a stream and holds one message at a time, so a conversation of any length, even
a third of all rows, needs no more memory than its longest message.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# The template's control strings.
TURN, END_TURN, ANSWER, END_ANSWER = "[INST]", "[/INST]", "<s>", "</s>"
CONTROLS = (TURN, END_TURN, ANSWER, END_ANSWER)
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(
    r"\[INST\](?P<role>(?:[^\\\n]|\\.)*)\n(?P<text>.*?)\[/INST\]|<s>(?P<answer>.*?)</s>", re.S
)
# Tasks hand on messages in groups of about so many characters.
FLUSH_CHARS = 4 << 20


def escape(text: str) -> str:
    """Text without any control string: backslashes are doubled, and one breaks each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its loss mask begins and ends (equal: no loss)."""
    if role == "assistant":
        body = escape(text)
        return f"{ANSWER}{body}{END_ANSWER}", len(ANSWER), len(ANSWER) + len(body)
    return f"{TURN}{escape(role).replace(chr(10), chr(92) + chr(10))}\n{escape(text)}{END_TURN}", 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted text."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text outside of any turn")
        at = m.end()
        found.append(("assistant", unescape(m["answer"])) if m["answer"] is not None else (unescape(m["role"]), unescape(m["text"])))
    if at != len(formatted):
        raise ValueError("text outside of any turn")
    return found


def events_of(conversations: DataFrame) -> DataFrame:
    """An event log whose final messages are the rows of conversations, in order of turn.

    Columns: conv_id, turn, role, order (a hash of the text), message, step, kind, piece. Every row
    streams in as two deltas; answers were generated twice, and every third turn was edited into its final form. Rows
    of one turn follow each other by role, then order. Every row is a message with an id of its own, so
    rows that repeat all columns stay apart; which of them has which id makes no difference. Null
    role or text is empty.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("message"),
    )
    half = F.floor(F.length("text") / 2).cast("int")
    head, tail = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text") - half)
    event = lambda step, kind, text: F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("piece"))
    start, blank = event(0, "start", F.lit("")), F.lit("")
    streamed = [event(3, "delta", head), event(4, "delta", tail)]
    redone = [event(1, "delta", head), event(2, "regenerate", blank), *streamed]
    edited = [event(1, "delta", head), event(2, "edit", F.col("text"))]
    log = (
        F.when(F.col("turn") % 3 == 2, F.array(start, *edited))
        .when(F.col("role") == "assistant", F.array(start, *redone))
        .otherwise(F.array(start, *streamed))
    )
    return rows.select("conv_id", "turn", "role", F.xxhash64("text").alias("order"), "message", F.inline(log))


def fold(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, object, str, str]]:
    """conversation, place of the message in it, role and final text, from events in order.

    The events of a message, by its id, stand together; without the column `message` every start begins another one.
    """
    conv, place, role, pieces, is_open, own = None, -1, "", [], False, None
    for batch in batches:
        ids = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
        messages = batch["message"] if "message" in batch else [None] * len(batch)
        for key, message, who, kind, piece in zip(ids, messages, batch["role"], batch["kind"], batch["piece"]):
            again = is_open and message is not None and (key, message) == (conv, own)
            if kind == "start" and again:
                role, pieces = who, []
            elif kind == "start":
                if is_open:
                    yield conv, place, role, "".join(pieces)
                place = place + 1 if is_open and key == conv else 0
                conv, role, pieces, is_open, own = key, who, [], True, message
            elif message is not None and not again:
                raise ValueError(f"an event of a message that has not begun: {message}")
            elif kind == "delta":
                pieces.append(piece)
            elif kind == "edit":
                pieces = [piece]
            elif kind == "regenerate":
                pieces = []
            else:
                raise ValueError(f"unknown kind of event: {kind}")
    if is_open:
        yield conv, place, role, "".join(pieces)


FORMATTED = "conv_id long, place long, formatted string, loss_start int, loss_end int"


def _format(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out, size = [], 0
    columns = ["conv_id", "place", "formatted", "loss_start", "loss_end"]
    for conv, place, role, text in fold(batches):
        out.append((None if conv is None else int(conv), place, *render(role, text)))
        size += len(text)
        if size > FLUSH_CHARS:
            yield _typed(pd.DataFrame(out, columns=columns))
            out, size = [], 0
    if out:
        yield _typed(pd.DataFrame(out, columns=columns))


def _typed(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.assign(conv_id=frame["conv_id"].astype("Int64"))


def format_events(log: DataFrame, order: list[str]) -> DataFrame:
    """A row per final message: conv_id, place, formatted text of the turn, loss mask in it.

    The formatted conversation is its turns joined in order of place. `order` names the columns
    that put a conversation's events in sequence: the last one the events of a message, the others, equal in all
    events of a message, the messages; messages equal in these are told apart by their ids.
    A missing conv_id is a conversation as well.
    """
    *places, step = order
    keys = ["conv_id", *places, "message", step]
    dealt = log.select(*keys, *[c for c in ("role", "kind", "piece") if c not in keys])
    sorted_log = dealt.repartition("conv_id").sortWithinPartitions(*keys)
    return sorted_log.select("conv_id", "message", "role", "kind", "piece").mapInPandas(_format, FORMATTED)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state = None
    columns = [c.split()[0] for c in DIGEST.split(", ")]

    def closed():
        conv, n, turns, loss_n, loss, chars = state
        return (conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars)

    for batch in batches:
        rows = []
        ids = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
        for key, formatted, start, end in zip(ids, batch["formatted"], batch["loss_start"], batch["loss_end"]):
            key = None if key is None else int(key)
            if state is None or state[0] != key:
                if state is not None:
                    rows.append(closed())
                state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            masked = unescape(formatted[start:end])
            state[3] += len(masked)
            state[4].update(masked.encode())
            state[5] += len(formatted)
        if rows:
            yield _typed(pd.DataFrame(rows, columns=columns))
    if state is not None:
        yield _typed(pd.DataFrame([closed()], columns=columns))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation its turns, parsed from the formatted texts, and its masked text, as digests.

    A digest is made in order, in one stream per conversation; only its state is held.
    """
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.mapInPandas(_digest, DIGEST)
