"""Chat formatting with a grammar round trip.

Each turn is rendered by a template, the rendered text is reparsed by a strict parser, and the recovered
turn is compared with the source.  Where they differ, the content is escaped and the round repeated until both
are identical.  A formatted conversation is the concatenation of its turns' segments.

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    other      <|role|>text<|/|>

Content must hold no control string; an escape breaks one up after its first character, reversibly.

Defined results: a null text or role is empty; turns with equal numbers stand in the order of role, then text, null
turns first; rows with a null conversation id form one conversation; repeated rows are repeated turns; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_arrow, table

# The control strings.
NAMED = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER, OTHER_ENDS, OTHER_CLOSES = "<|", "|>", "<|/|>"
ESCAPE = "␛"

CONTROL = re.compile("|".join(re.escape(x) for pair in NAMED.values() for x in pair) + r"|<\||\|>")
_ESCAPED = re.compile(f"{ESCAPE}[em]")

SEGMENT = "conv_id long, turn long, role string, segment string, loss_start int, loss_stop int, rounds int"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Conflict(ValueError):
    """The text is no sequence of turns of the grammar."""


def escape(text: str) -> str:
    text = text.replace(ESCAPE, ESCAPE + "e")
    while CONTROL.search(text):
        text = CONTROL.sub(lambda m: f"{m[0][0]}{ESCAPE}m{m[0][1:]}", text)
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPE if m[0][1] == "e" else "", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment and where its content stands there."""
    opening, closing = NAMED.get(role) or (f"{OTHER}{role}{OTHER_ENDS}", OTHER_CLOSES)
    return opening + text + closing, len(opening), len(opening) + len(text)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; deterministic: the control string that comes next decides."""
    turns, at = [], 0

    def expect(word: str) -> None:
        nonlocal at
        if not text.startswith(word, at):
            raise Conflict(f"{word} expected at {at}")
        at += len(word)

    def content() -> str:
        nonlocal at
        found = CONTROL.search(text, at)
        if not found:
            raise Conflict(f"no end of the content at {at}")
        start, at = at, found.start()
        return unescape(text[start:at])

    while at < len(text):
        role = next((r for r, (opening, _) in NAMED.items() if text.startswith(opening, at)), None)
        if role is not None:
            expect(NAMED[role][0])
            closing = NAMED[role][1]
        else:
            expect(OTHER)
            role, closing = content(), OTHER_CLOSES
            if role in NAMED:
                raise Conflict(f"role {role} has control strings of its own")
            expect(OTHER_ENDS)
        body = content()
        expect(closing)
        turns.append((role, body))
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """Segment, start and end of the content in it, and the rounds it took."""
    # The closing mark keeps the end of escaped content from joining with the control string behind it, so the last round always agrees.
    closed = ESCAPE + "m"
    last = role if role in NAMED else escape(role) + closed
    for rounds, (a, b) in enumerate(((role, text), (role, escape(text)), (last, escape(text) + closed)), 1):
        segment, start, stop = render(a, b)
        try:
            if parse(segment) == [(role, text)]:
                return segment, start, stop, rounds
        except Conflict:
            pass
    raise AssertionError("an escaped turn does not parse")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with its segment; the loss mask covers the content of assistant turns (``loss_start`` to ``loss_stop``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SEGMENT.split(", ")]
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                segment, start, stop, rounds = format_turn(role, text)
                if role != "assistant":
                    start = stop = 0
                out.append((conv, turn, role, segment, start, stop, rounds))
            yield as_arrow(SEGMENT, dict(zip(names, zip(*out) if out else [[]] * len(names))))

    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(run, SEGMENT)


def digests(segments: DataFrame) -> DataFrame:
    """Read formatted conversations back: one row each, with hashes of the recovered turns.

    A hash over a conversation needs its turns one after another; they stream through a task, of which
    only the state of the hashes is kept, however long the conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGEST.split(", ")]
        current, state = None, None

        def line():
            turns, whole, chars, loss, size = state
            return (current[0], turns, whole.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            out = []
            for conv, segment, start, stop in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_stop"))):
                if current != (conv,):
                    if current:
                        out.append(line())
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                learned = unescape(segment[start:stop])
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
            if out:
                yield as_arrow(DIGEST, dict(zip(names, zip(*out))))
        if current:
            yield as_arrow(DIGEST, dict(zip(names, zip(line()))))

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")
    return ordered.mapInArrow(run, DIGEST)


def op2_chat(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return digests(format_turns(given.unionByName(extra)))
