"""Chat formatting: a state machine over roles, and text segments with loss flags from a declarative template.

Control strings inside texts are broken reversibly: one backslash more goes behind their first character, and reading
back takes one out. A formatted text therefore holds a control string only where the template put it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import map_arrow


@dataclass(frozen=True)
class Turn:
    """How a role's turns are marked, and whether their text counts in the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, the mark of other roles, and the roles that may follow each state."""

    turns: dict[str, Turn]
    #: Roles without marks of their own: the (escaped) name stands between the two parts.
    other: tuple[str, str, str]
    #: state -> roles that may come next; states are "" (start) and the role before.
    follows: dict[str, frozenset[str]]
    #: States in which a conversation may end.
    ends: frozenset[str]

    def controls(self) -> list[str]:
        marks = [m.strip() for t in self.turns.values() for m in (t.before, t.after)] + [m.strip() for m in self.other]
        return sorted({m for m in marks if m}, key=lambda m: (-len(m), m))


#: Instruction marks; what a system or unknown role says has marks of its own, so every order can be read back.
INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>", loss=True),
    },
    other=("[ROLE] ", " [TEXT] ", " [/ROLE]"),
    follows={
        "": frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    ends=frozenset({"assistant"}),
)


class Formatter:
    """Segments of one turn after the other, and the way back."""

    def __init__(self, template: Template):
        self.template = template
        controls = "|".join(f"{re.escape(c[0])}{{}}{re.escape(c[1:])}" for c in template.controls())
        self.broken = re.compile(controls.replace("{}", r"\\+"))
        self.breakable = re.compile(controls.replace("{}", r"\\*"))

    def escape(self, text: str) -> str:
        return self.breakable.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return self.broken.sub(lambda m: m[0][0] + m[0][2:], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Text and loss flag of the pieces of one turn: mark, content, mark."""
        turn = self.template.turns.get(role)
        if turn:
            return [(turn.before, False), (self.escape(text), turn.loss), (turn.after, False)]
        opened, middle, closed = self.template.other
        return [(opened + self.escape(role) + middle, False), (self.escape(text), False), (closed, False)]

    def read(self, formatted: str) -> tuple[str, str, bool]:
        """Role, text and loss flag of one formatted turn."""
        for role, turn in self.template.turns.items():
            if formatted.startswith(turn.before):
                inner = formatted[len(turn.before) : len(formatted) - len(turn.after)]
                return role, self.unescape(inner), turn.loss
        opened, middle, closed = self.template.other
        role, _, text = formatted[len(opened) : len(formatted) - len(closed)].partition(middle)
        return self.unescape(role), self.unescape(text), False


SEGMENTS = "array<struct<text:string,loss:boolean>>"


def format_chat(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, turn, valid, segments: one row per row of ``turns``, in order inside each conversation.

    ``segments`` are (text, loss); joined over a conversation they are its formatted text. ``valid`` tells
    whether the state machine allows this role after the one before and, on the last row, an end after it.
    Rows are ordered by turn (null first), then role and text; repeated rows are turns of their own. A
    null text or role counts as empty, and rows with a null conv_id form one conversation. Extra columns are not read.

    Conversations are dealt out by id and sorted, and rows stream through a task with only the state of the
    present conversation in memory; a conversation of any length spills but is never gathered.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", empty("role").alias("role"), empty("text").alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    shape = Formatter(template)

    def run(batches) -> Iterator[dict]:
        held: dict[str, list] | None = None  # the latest row waits, as its successor tells whether it is the last
        state, current = "", None
        for batch in batches:
            out: dict[str, list] = {"conv_id": [], "turn": [], "valid": [], "segments": []}
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))
            for conv, turn, role, text in zip(*columns):
                if held is None or conv != current:
                    if held:
                        held["valid"] = [held["valid"][0] and state in template.ends]
                    state, current = "", conv
                if held:
                    for c in out:
                        out[c] += held[c]
                held = {
                    "conv_id": [conv],
                    "turn": [turn],
                    "valid": [role in template.follows.get(state, ())],
                    "segments": [[{"text": t, "loss": loss} for t, loss in shape.segments(role, text)]],
                }
                state = role
            yield out
        if held:
            held["valid"] = [held["valid"][0] and state in template.ends]
            yield held

    kinds = [turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    return map_arrow(ordered, run, f"conv_id {kinds[0]}, turn {kinds[1]}, valid boolean, segments {SEGMENTS}")


def digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_invalid, read from segments.

    Takes the rows as :func:`format_chat` leaves them, conversation after conversation in each partition, and
    keeps only running digests, so it needs no shuffle.
    """
    shape = Formatter(template)

    def run(batches) -> Iterator[dict]:
        state: dict | None = None

        def closed() -> dict:
            return {
                "conv_id": [state["conv_id"]],
                "n_turns": [state["n"]],
                "turns_sha256": [state["turns"].hexdigest()],
                "loss_chars": [state["loss_chars"]],
                "loss_sha256": [state["loss"].hexdigest()],
                "formatted_chars": [state["chars"]],
                "n_invalid": [state["invalid"]],
            }

        for batch in batches:
            out: list[dict] = []
            for conv, valid, segments in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "valid", "segments"))):
                if state is None or state["conv_id"] != conv:
                    if state:
                        out.append(closed())
                    state = {"conv_id": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                    state |= {"loss_chars": 0, "chars": 0, "invalid": 0}
                whole = "".join(s["text"] for s in segments)
                role, text, _ = shape.read(whole)
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(whole)
                state["invalid"] += not valid
                for s in segments:
                    if s["loss"]:
                        learned = shape.unescape(s["text"])
                        state["loss"].update(learned.encode())
                        state["loss_chars"] += len(learned)
            if out:
                yield {c: [x for row in out for x in row[c]] for c in out[0]}
        if state:
            yield closed()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return map_arrow(
        formatted.select("conv_id", "valid", "segments"),
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_invalid long",
    )
