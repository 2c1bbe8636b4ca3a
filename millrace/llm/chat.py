"""Chat formatting: a finite-state machine over roles, and a template with loss flags.

A :class:`Template` declares for every role the control strings that open and close its turns
and whether its text is learnt, and which role may follow which. Formatting gives for every turn
its *segments*: pieces of text, each with a loss flag. Concatenating the segments of all turns
gives the formatted conversation.

Control strings inside texts are escaped so that no text can pass for a control string: every
backslash is doubled, then a backslash is put behind the first character of each control string.
Both steps can be undone, see :func:`unescape`. Conversations that break the turn order are
formatted as they are and marked with their first wrong turn.

Rows stream through tasks sorted by conversation and turn, so a conversation may be of any
length: a task holds one batch of rows. Only the state of the machine is kept between rows.

Edge cases: null text or role counts as empty; a role without a template is written by the
``other`` form, which holds the role's name; rows of one turn number are ordered by role and
text, repeated rows are turns of their own; null turns come first; rows with a null conversation
id form one conversation with a null id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Form:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Control strings must be distinct, start with one of ``<[`` and hold these and ``\\`` nowhere else."""

    forms: dict[str, Form]
    other: Form
    name_end: str
    follows: dict[str, set[str]] = field(default_factory=dict)

    def controls(self) -> list[str]:
        found = [self.other.open, self.other.close, self.name_end]
        for form in self.forms.values():
            found += [form.open, form.close]
        return found

    def __post_init__(self):
        found = self.controls()
        if len(set(found)) < len(found) or not all(re.fullmatch(r"[<\[][^<\[\\]+", c) for c in found):
            raise ValueError("control strings must be distinct and start with < or [")


#: The machine starts in state "" and is in the state of its last role afterwards.
DEFAULT = Template(
    forms={
        "system": Form("[SYS]", "[/SYS]"),
        "user": Form("[INST]", "[/INST]"),
        "assistant": Form("<s>", "</s>", loss=True),
    },
    other=Form("[TURN]", "[/TURN]"),
    name_end="[TEXT]",
    follows={"": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}},
)

SEGMENTS = "array<struct<text:string,loss:boolean>>"
FORMATTED = f"conv_id long, position long, role string, wrong boolean, segments {SEGMENTS}"


def escape(text: str, controls: re.Pattern) -> str:
    return controls.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def any_of(controls: list[str]) -> re.Pattern:
    return re.compile("|".join(re.escape(c) for c in sorted(controls, key=len, reverse=True)))


def formatter(template: Template):
    def run(batches):
        controls = any_of(template.controls())
        at, position, state = object(), 0, ""
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != at:
                    at, position, state = conv, 0, ""
                wrong = role not in template.follows.get(state, set())
                form = template.forms.get(role)
                opened = form.open if form else template.other.open + escape(role, controls) + template.name_end
                form = form or template.other
                segments = [{"text": opened, "loss": False}, {"text": escape(text, controls), "loss": form.loss}, {"text": form.close, "loss": False}]
                out.append({"conv_id": conv, "position": position, "role": role, "wrong": wrong, "segments": segments})
                position, state = position + 1, role
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return run


SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("wrong", pa.bool_()),
    ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
])


def format_conversations(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per turn: ``conv_id``, ``position``, ``role``, ``wrong`` (the turn may not follow the
    one before) and ``segments``. Rows of a conversation stay together and in order.
    """
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(formatter(template), FORMATTED)


def reader(template: Template):
    """Parses the text of the segments alone; loss flags give the learnt characters."""

    def run(batches):
        controls = any_of(template.controls())
        opens = {form.open: (role, form.close) for role, form in template.forms.items()}
        at = object()
        done = None

        def finish(state):
            return {
                "conv_id": at, "n_turns": state["turns"], "turns_sha256": state["all"].hexdigest(), "loss_chars": state["learnt"],
                "loss_sha256": state["loss"].hexdigest(), "formatted_chars": state["chars"], "first_wrong": state["wrong"],
            }

        for batch in batches:
            out = []
            for conv, position, wrong, segments in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "wrong", "segments")), strict=True):
                if conv != at or done is None:
                    if done is not None:
                        out.append(finish(done))
                    at = conv
                    done = {"turns": 0, "all": hashlib.sha256(), "learnt": 0, "loss": hashlib.sha256(), "chars": 0, "wrong": None}
                if wrong and done["wrong"] is None:
                    done["wrong"] = position
                whole = "".join(s["text"] for s in segments)
                done["chars"] += len(whole)
                for role, text in turns(whole, controls, opens, template):
                    done["turns"] += 1
                    done["all"].update(f"{role}\n{text}\n".encode())
                for segment in segments:
                    if segment["loss"]:
                        plain = unescape(segment["text"])
                        done["learnt"] += len(plain)
                        done["loss"].update(plain.encode())
            yield pa.RecordBatch.from_pylist(out, schema=READ)
        if done is not None:
            yield pa.RecordBatch.from_pylist([finish(done)], schema=READ)

    return run


def turns(whole: str, controls: re.Pattern, opens: dict, template: Template):
    """Role and text of every turn in a formatted text."""
    at = 0
    while at < len(whole):
        opened = controls.match(whole, at)
        at = opened.end()
        if opened[0] in opens:
            role, close = opens[opened[0]]
        else:
            named = controls.search(whole, at)
            role, close, at = unescape(whole[at : named.start()]), template.other.close, named.end()
        ended = controls.search(whole, at)
        if ended[0] != close:
            raise ValueError("a turn is not closed")
        yield role, unescape(whole[at : ended.start()])
        at = ended.end()


READ = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("first_wrong", pa.int64()),
])


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per conversation: digests of the turns and of the learnt text, from the formatted text.

    Takes the rows as :func:`format_conversations` gives them, together and in order.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, first_wrong long"
    return formatted.mapInArrow(reader(template), schema)
