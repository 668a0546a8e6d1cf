r"""Chat formatting of typed content parts.

A visitor flattens the parts of a turn in order: text is escaped, every image,
audio or document part becomes a placeholder, is recorded as an attachment
reference and counts the tokens that the model will expand it to.

Template of a turn (a conversation is its turns in order)::

    <turn role=ROLE>
    CONTENT</turn>

with a line end after each marker.  Inside texts ``\`` becomes ``\\`` and ``<`` becomes ``\<``, so no text can
contain a marker or placeholder and unescaping is exact; in roles ``>`` is
escaped likewise.  The loss mask covers the text of assistant turns, not the markers.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD, HEAD_END, FOOT = "<turn role=", ">\n", "</turn>\n"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
HEADER = re.compile(r"<turn role=((?:[^\\>]|\\.)*)>\n", re.DOTALL)

PART = (T.StructType().add("type", T.StringType()).add("text", T.StringType()).add("uri", T.StringType())
        .add("width", T.IntegerType()).add("height", T.IntegerType()).add("seconds", T.DoubleType()).add("pages", T.IntegerType()))
TURN = ("formatted string, loss array<struct<start:long,end:long>>, "
        "attachments array<struct<ref:int,type:string,uri:string,tokens:long>>, n_tokens long")


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder expands to."""

    image_tile: int = 512
    tokens_per_tile: int = 256
    tokens_per_second: float = 25.0
    tokens_per_page: int = 1024


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of one turn."""

    expansion: Expansion = field(default_factory=Expansion)
    pieces: list[str] = field(default_factory=list)
    size: int = 0
    texts: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[int, str, str, int]] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part) -> None:
        kind = part["type"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def attach(self, part, tokens: int) -> None:
        ref = len(self.attachments)
        self.attachments.append((ref, part["type"], part["uri"], tokens))
        self.tokens += tokens
        self.add(f"<{part['type']}:{ref}>")

    def visit_text(self, part) -> None:
        text = part["text"] or ""
        start = self.size
        self.add(escape(text))
        if self.size > start:
            self.texts.append((start, self.size))
        self.tokens += len(text.split())

    def visit_image(self, part) -> None:
        e = self.expansion
        tiles = math.prod(max(1, math.ceil((number(part[k]) or 1) / e.image_tile)) for k in ("width", "height"))
        self.attach(part, tiles * e.tokens_per_tile)

    def visit_audio(self, part) -> None:
        self.attach(part, math.ceil((number(part["seconds"]) or 0) * self.expansion.tokens_per_second))

    def visit_document(self, part) -> None:
        self.attach(part, int(number(part["pages"]) or 1) * self.expansion.tokens_per_page)

    def visit_other(self, part) -> None:
        raise ValueError(f"content part of unknown type {part['type']!r}")


def number(x):
    return None if x is None or x != x else x


def format_turn(role: str | None, parts, expansion: Expansion) -> tuple:
    """formatted, loss spans, attachments, tokens of one turn."""
    head = HEAD + escape(role or "").replace(">", "\\>") + HEAD_END
    f = Flattener(expansion)
    for part in (() if parts is None else parts):
        f.visit(part)
    loss = [(a + len(head), b + len(head)) for a, b in f.texts] if role == "assistant" else []
    return head + "".join(f.pieces) + FOOT, loss, f.attachments, f.tokens


def text_part(text) -> F.Column:
    """A text column as the one part of its turn."""
    none = {x.name: F.lit(None).cast(x.dataType) for x in PART}
    return F.array(F.struct(*[c.alias(k) for k, c in (none | {"type": F.lit("text"), "text": text}).items()]))


def format_turns(df: DataFrame, role: str = "role", parts: str = "parts", expansion: Expansion = Expansion()) -> DataFrame:
    """``df`` with the columns formatted, loss (spans in it, code points, end
    exclusive), attachments and n_tokens.  One row per turn, no shuffle.

    A null role is the empty one; null parts and null texts are empty; a part
    without a type is text, one of an unknown type is an error.  Columns of
    these names are replaced, others kept."""
    @F.pandas_udf(TURN)
    def turn(roles: pd.Series, content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([format_turn(r, p, expansion) for r, p in zip(roles, content)],
                            columns=["formatted", "loss", "attachments", "n_tokens"])

    names = ["formatted", "loss", "attachments", "n_tokens"]
    out = df.withColumn("__turn", turn(F.col(role), F.col(parts)))
    return out.withColumns({n: F.col("__turn")[n] for n in names}).drop("__turn")


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and content of a formatted turn (placeholders stay as they are)."""
    m = HEADER.match(formatted)
    if not m or not formatted.endswith(FOOT):
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(formatted[m.end():-len(FOOT)])


def read_back(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation, read from its formatted turns: (conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Turns come in order of ``turn`` (null first), ties by their formatted text.
    A conversation is digested as its sorted turns stream by, so a task holds
    one Arrow batch however long a conversation is.  Null ids are one conversation."""
    kind = turns.schema[conv_id].dataType.simpleString()
    schema = (f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, done = None, []
        for frame in batches:
            for key, formatted, loss in zip(frame["key"], frame["formatted"], frame["loss"]):
                if state is None or state[0] != key:
                    if state:
                        done.append(state)
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(formatted)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    under = unescape(formatted[span["start"]:span["end"]])
                    state[3] += len(under)
                    state[4].update(under.encode())
                state[5] += len(formatted)
            if done:
                yield table(done)
                done = []
        if state:
            yield table([*done, state])

    def table(states: list) -> pd.DataFrame:
        rows = [(k, n, a.hexdigest(), c, b.hexdigest(), f) for k, n, a, c, b, f in states]
        return pd.DataFrame(rows, columns=["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    key = F.col(conv_id).cast("string")
    rows = turns.select(F.coalesce(F.concat(F.lit("="), key), F.lit("")).alias("key"), F.col(turn).alias("turn"),
                        "formatted", "loss")
    out = (rows.repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "formatted")
           .select("key", "formatted", "loss")
           .mapInPandas(digest, schema.replace(f"conv_id {kind}", "key string", 1)))
    return out.select(F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(kind).alias("conv_id"),
                      *[F.col(c) for c in out.columns if c != "key"])
