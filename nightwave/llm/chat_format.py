"""Chat formatting by a finite-state machine over roles and a declarative template.

A template names its markers, the legal successions of roles and the roles that are learned from. The machine walks a
conversation turn by turn and emits text segments, each with its loss flag; a turn out of order is formatted all the
same and flagged, so nothing is lost. Control strings inside texts and roles (the template's own and other usual ones)
get a backslash after their first character, runs of backslashes there grow by one, so escaping is reversible and a
marker in the output is always a marker.

Rows are dealt out by conversation, sorted by turn and read as a stream that carries the machine's state from batch to
batch: a conversation of any length takes the memory of one batch. (The digest of one conversation is one sequential
computation, so a conversation is never spread over tasks.)

Defined cases: null texts and roles are empty; turns go by (turn, role, text), nulls first, so ties and repeated rows have an order
and each counts; rows with null conv_id are one conversation; unknown roles are formatted and invalid; a conversation is
valid if every turn follows from the one before and it ends with an accepted role; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings of usual chat formats; fixed values.
RESERVED = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


@dataclass(frozen=True)
class Template:
    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    reserved: tuple[str, ...] = RESERVED
    follows: dict = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    accepts: tuple[str, ...] = ("assistant",)
    learned: tuple[str, ...] = ("assistant",)

    @property
    def _hide(self) -> re.Pattern:
        return re.compile("|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in self.reserved))

    @property
    def _show(self) -> re.Pattern:
        return re.compile("|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in self.reserved))

    def escape(self, text: str) -> str:
        return self._hide.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._show.sub("", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, whether it is under the loss) of one turn."""
        name = self.escape(role).replace("%", "%25").replace("\n", "%0A")
        return [(f"{self.opening}{name}{self.after_role}", False), (self.escape(text), role in self.learned), (self.closing, False)]

    def read(self, formatted: str) -> tuple[list[tuple[str, str]], int]:
        """(role, text) of each whole turn at the beginning of a formatted text, and where the last of them ends."""
        turns, at = [], 0
        while formatted.startswith(self.opening, at):
            begin = at + len(self.opening)
            middle = formatted.find(self.after_role, begin)
            stop = formatted.find(self.closing, middle) if middle >= 0 else -1
            if stop < 0:
                break
            name = formatted[begin:middle].replace("%0A", "\n").replace("%25", "%")
            turns.append((self.unescape(name), self.unescape(formatted[middle + len(self.after_role):stop])))
            at = stop + len(self.closing)
        return turns, at


SEGMENTS = "conv_id long, place long, segments array<struct<text:string,loss:boolean>>, valid_turn boolean, state string"


def format_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, place (from 0), segments, valid_turn, state (the machine's after the turn) of every turn, each conversation's rows together and in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, place, state = False, None, 0, ""
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for c, role, text in zip(b["conv_id"].to_pylist(), b["role"].to_pylist(), b["text"].to_pylist()):
                if not started or c != conv:
                    started, conv, place, state = True, c, 0, ""
                valid = role in template.follows.get(state, ())
                state = role
                for to, x in zip(out, (c, place, [{"text": t, "loss": on} for t, on in template.segments(role, text)], valid, state)):
                    to.append(x)
                place += 1
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["conv_id", "place", "segments", "valid_turn", "state"])

    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, SEGMENTS)


class _Reader:
    """Digests of one conversation, read from its segments joined to one text, and from the stretches of it under the loss mask.

    Where a turn begins and ends is told by the markers in the text alone; what is not yet a whole turn is kept back.
    """

    def __init__(self, template: Template):
        self.template, self.turns, self.loss = template, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.valid, self.state, self.rest, self.learned = True, "", "", ""

    def take(self, segments: list[dict], valid: bool, state: str) -> None:
        for s in segments:
            self.rest += s["text"]
            self.chars += len(s["text"])
            if s["loss"]:
                self.learned += s["text"]
            else:
                self._learn()
        turns, stop = self.template.read(self.rest)
        self.rest = self.rest[stop:]
        for role, text in turns:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        self.valid, self.state = self.valid and valid, state

    def _learn(self) -> None:
        """Ends a stretch under the mask."""
        text = self.template.unescape(self.learned)
        self.loss.update(text.encode())
        self.loss_chars += len(text)
        self.learned = ""

    def row(self) -> list:
        self._learn()
        if self.rest:
            raise ValueError("a formatted conversation ends within a turn")
        return [self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid and self.state in self.template.accepts]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id and what can be read back from the rows of `format_turns`, taken as they come; nothing is dealt out anew."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, reader = None, None
        names, kinds = [x.split()[0] for x in DIGESTS.split(", ")], (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            done = []
            for c, place, segments, valid, state in zip(*(b[n].to_pylist() for n in ("conv_id", "place", "segments", "valid_turn", "state"))):
                if place == 0:
                    if reader:
                        done.append([conv, *reader.row()])
                    conv, reader = c, _Reader(template)
                reader.take(segments, valid, state)
            if done:
                yield batch(done)
        if reader:
            yield batch([[conv, *reader.row()]])

    return formatted.mapInArrow(run, DIGESTS)
