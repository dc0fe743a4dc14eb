"""Chat formatting: a finite-state machine over roles, a declarative template, and a reader of the result.

A conversation becomes segments of text, each with a loss flag. The machine checks the order of roles: an optional
system turn, then user and assistant in turn. A conversation that breaks the order is formatted all the same and
told by `first_bad`. Control strings inside roles and texts are escaped, so that the reader gets them back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_MARK = re.compile(r"<(\\*)\|")
ESCAPED_MARK = re.compile(r"<(\\*)\\\|")


@dataclass(frozen=True)
class Template:
    """Control strings all begin with <|. steps: (state, role) to state; a pair that is missing is an error."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    line: str = "<|nl|>"  # stands for a line feed in a role
    loss_roles: frozenset[str] = frozenset({"assistant"})
    first: str = "begin"
    steps: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("begin", "system"): "system",
            ("begin", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """One turn as (text, under the loss mask)."""
        name = escape(role).replace("\n", self.line)
        return [
            (f"{self.start}{name}\n", False),
            (escape(text), role in self.loss_roles),
            (f"{self.end}\n", False),
        ]

    def read_turn(self, turn: str) -> tuple[str, str]:
        """Role and text of one formatted turn without its end."""
        if not turn.startswith(self.start):
            raise ValueError("a turn without its start")
        name, _, text = turn[len(self.start) :].partition("\n")
        return unescape(name.replace(self.line, "\n")), unescape(text)


def escape(text: str) -> str:
    """Adds a backslash inside every <|, <\\|, <\\\\| ...: no control string is left, and no two texts become one."""
    return OPEN_MARK.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return ESCAPED_MARK.sub(r"<\1|", text) if "<" in text else text


def segments(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, segment (long), text, loss and bad: the segments of every conversation, in order in its partition.

    conversations: conv_id, turn, role, text. Turns are ordered by turn, then role and text, so ties and repeated
    rows have an order; all of them are kept. A null role or text is empty, a null conv_id one conversation.
    bad is true on the segments of a turn that the machine does not allow, and of those after it.
    Turns stream through a task in order: of a conversation only its state is held, whatever its length.
    """
    template = template or Template()
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = (
        conversations.select(
            "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, current, state, number = False, None, template.first, 0
        for batch in batches:
            out: list[tuple] = []
            for conv, role, text in zip(
                batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(),
                strict=True,
            ):
                if not begun or conv != current:
                    begun, current, state, number = True, conv, template.first, 0
                state = template.steps.get((state, role), "") if state else ""
                for part, loss in template.segments(role, text):
                    out.append((conv, number, part, loss, not state))
                    number += 1
            if out:
                columns = list(zip(*out, strict=True))
                kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["conv_id", "segment", "text", "loss", "bad"],
                )

    return rows.mapInArrow(work, f"conv_id {kind}, segment bigint, text string, loss boolean, bad boolean")


def formatted(parts: DataFrame) -> DataFrame:
    """conv_id, text and loss_spans (start, end in code points) of every conversation, from its segments."""
    ordered = F.sort_array(F.collect_list(F.struct("segment", "text", "loss", "bad")))
    grouped = parts.groupBy("conv_id").agg(ordered.alias("_s"))
    step = F.aggregate(
        "_s",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s["text"])).alias("at"),
            F.when(
                s["loss"],
                F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), (a["at"] + F.length(s["text"])).alias("end")))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
    )
    return grouped.select(
        "conv_id", F.array_join(F.col("_s.text"), "").alias("text"), step["spans"].alias("loss_spans"),
        F.exists(F.col("_s.bad"), lambda b: b).alias("bad"),
    )


@dataclass
class Reader:
    """Reads one conversation back, a piece of formatted text at a time; holds at most one turn."""

    template: Template
    rest: str = ""
    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    bad_at: int | None = None

    def __post_init__(self):
        self.all_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss: bool, bad: bool) -> None:
        self.chars += len(piece)
        self.rest += piece
        if bad and self.bad_at is None:
            self.bad_at = self.turns
        if loss:
            text = unescape(piece)
            self.loss_chars += len(text)
            self.loss_digest.update(text.encode())
        close = self.template.end + "\n"
        while piece.endswith(close) and (at := self.rest.find(close)) >= 0:
            role, text = self.template.read_turn(self.rest[:at])
            self.rest = self.rest[at + len(close) :]
            self.turns += 1
            self.all_digest.update(f"{role}\n{text}\n".encode())

    def result(self) -> tuple:
        if self.rest:
            raise ValueError("text after the last turn")
        return (
            self.turns, self.all_digest.hexdigest(), self.loss_chars, self.loss_digest.hexdigest(), self.chars,
            self.bad_at is None, self.bad_at,
        )


READ_BACK = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
    "valid boolean, first_bad bigint"
)


def read_back(parts: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, digests and sizes of every conversation, and whether its roles were in order.

    parts: the segments, in order and together for each conversation, as segments() leaves them in a partition.
    """
    template = template or Template()
    kind = parts.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[f.split(" ")[0] for f in READ_BACK.split(", ")]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, types = None, None, None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            types = [
                batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
                pa.bool_(), pa.int64(),
            ]
            done: list[tuple] = []
            for conv, text, loss, bad, number in zip(
                *[batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "bad", "segment")], strict=True
            ):
                if reader is None or number == 0:
                    if reader is not None:
                        done.append((current, *reader.result()))
                    reader, current = Reader(template), conv
                reader.feed(text, loss, bad)
            if done:
                yield rows(done)
        if reader is not None:
            yield rows([(current, *reader.result())])

    return parts.mapInArrow(work, f"conv_id {kind}, {READ_BACK}")
