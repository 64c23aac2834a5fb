"""Chat formatting with typed content parts.

A turn is a list of parts (text, image, audio, document). A visitor flattens
them in order: a text part becomes its escaped text; the other kinds become a
placeholder, an attachment reference (kind, uri, turn, part) and the number of
tokens that the placeholder stands for once expanded. Formatting also returns
the loss mask as spans of the assistant's texts.

Template, per turn: ``<|im_start|>`` role newline, body, ``<|im_end|>`` newline.

Escaping is reversible: wherever a control string of this or another common
template could begin inside a text or role, one backslash is put behind its
first character (more than there are already), so no text contains a control
string; unescaping takes one away again. In roles a line break is written
``\\n`` and a backslash ``\\\\``.

Defined results: turns are ordered by (turn, role, text), nulls first, so ties and
repeated rows have one order; a null text or role is empty; a null conv_id is
a conversation of its own; a part of an unknown kind is an error; an empty
table gives no conversation. Other columns are not read. A conversation is one
record, so its turns meet in one row, whatever their number.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import read_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings of common chat templates, without their first character.
CONTROL = r"\||/?s>|/?INST\]|/?SYS>>|start_of_turn>|end_of_turn>"
ESCAPE = re.compile(rf"([<\[])(\\*)(?={CONTROL})")
UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={CONTROL})")
PARTS = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Cost:
    """Expanded tokens of the parts that aren't text."""

    image_tile: int = 512        # pixels a side
    tokens_per_tile: int = 170
    image_base: int = 85
    audio_tokens_per_second: float = 12.5
    tokens_per_page: int = 750


@dataclass
class Flat:
    body: str = ""
    attachments: list[tuple[str, str, int, int, int]] = field(default_factory=list)  # kind, uri, turn, part, tokens


class Flatten:
    """Visits the parts of one turn in order."""

    def __init__(self, turn: int, cost: Cost) -> None:
        self.turn, self.cost, self.out, self.part = turn, cost, [], 0
        self.text: list[str] = []  # neighbouring text parts are escaped together
        self.attachments: list[tuple[str, str, int, int, int]] = []

    def visit(self, parts: Iterable[dict]) -> Flat:
        for self.part, p in enumerate(parts):
            kind = p.get("kind")
            handler = getattr(self, f"visit_{kind}", None)
            if handler is None:
                raise ValueError(f"unknown kind of part: {kind!r}")
            handler(p)
        self._end_text()
        return Flat("".join(self.out), self.attachments)

    def visit_text(self, p: dict) -> None:
        self.text.append(p.get("text") or "")

    def _end_text(self) -> None:
        self.out.append(escape("".join(self.text)))
        self.text = []

    def visit_image(self, p: dict) -> None:
        side = self.cost.image_tile
        tiles = math.ceil((p.get("width") or side) / side) * math.ceil((p.get("height") or side) / side)
        self._attach("image", p, self.cost.image_base + tiles * self.cost.tokens_per_tile)

    def visit_audio(self, p: dict) -> None:
        self._attach("audio", p, math.ceil((p.get("seconds") or 0) * self.cost.audio_tokens_per_second))

    def visit_document(self, p: dict) -> None:
        self._attach("document", p, (p.get("pages") or 1) * self.cost.tokens_per_page)

    def _attach(self, kind: str, p: dict, tokens: int) -> None:
        self._end_text()
        self.out.append(f"<|{kind}|>")
        self.attachments.append((kind, p.get("uri") or "", self.turn, self.part, tokens))


def format_turns(turns: Iterable[tuple[str | None, Iterable[dict]]], cost: Cost = Cost()) -> dict:
    """``formatted``, ``loss`` (spans of assistant bodies, start and end in code points), ``attachments``, ``n_expanded``."""
    out, at, loss, attachments = [], 0, [], []
    for i, (role, parts) in enumerate(turns):
        flat = Flatten(i, cost).visit(parts)
        head = f"{START}{_role_out(role or '')}\n"
        begin = at + len(head)
        if role == "assistant":
            loss.append((begin, begin + len(flat.body)))
        out += [head, flat.body, END]
        at = begin + len(flat.body) + len(END)
        attachments += flat.attachments
    return {"formatted": "".join(out), "loss": loss, "attachments": attachments, "n_expanded": sum(a[4] for a in attachments)}


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, body unescaped) of each turn of a formatted conversation; placeholders stay as they are."""
    out = []
    for piece in formatted.split(START)[1:]:
        role, _, body = piece.removesuffix(END).partition("\n")
        out.append((_role_in(role), unescape(body)))
    return out


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  parts: str = "parts") -> DataFrame:
    """conv_id and ``turns`` (role, parts in order) of each conversation."""
    one = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(parts).alias("parts"))
    rows = rows.select(F.col(conv_id).alias("conv_id"), one.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def text_parts(text: Column) -> Column:
    """A one-part list for a text column (null: empty text)."""
    none = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), none("string").alias("uri"),
                            none("int").alias("width"), none("int").alias("height"), none("double").alias("seconds"), none("int").alias("pages")))


FORMATTED = ("conv_id long, formatted string, loss array<struct<start:int,end:int>>, "
             "attachments array<struct<kind:string,uri:string,turn:int,part:int,tokens:int>>, n_expanded long")


def format_conversations(grouped: DataFrame, cost: Cost = Cost()) -> DataFrame:
    """The formatted text, loss spans and attachments of each conversation of ``conversations``."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for i in range(b.num_rows):  # one conversation at a time in Python
                turns = b.column("turns")[i].as_py()
                r = format_turns(((t["role"], t["parts"] or []) for t in turns), cost)
                made.append({"conv_id": b.column("conv_id")[i].as_py(), "formatted": r["formatted"],
                             "loss": [{"start": s, "end": e} for s, e in r["loss"]],
                             "attachments": [dict(zip(("kind", "uri", "turn", "part", "tokens"), a)) for a in r["attachments"]],
                             "n_expanded": r["n_expanded"]})
            yield pa.RecordBatch.from_pylist(made, schema=schema)

    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    ref = pa.struct([("kind", pa.string()), ("uri", pa.string()), ("turn", pa.int32()), ("part", pa.int32()), ("tokens", pa.int32())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(span)), ("attachments", pa.list_(ref)),
                        ("n_expanded", pa.int64())])
    return grouped.mapInArrow(run, FORMATTED)


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, taken from the formatted text alone."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = {k.split()[0]: [] for k in READ.split(", ")}
            for i in range(b.num_rows):
                text = b.column("formatted")[i].as_py()
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in b.column("loss")[i].as_py())
                values = (b.column("conv_id")[i].as_py(), len(turns),
                          hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                          len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
                for k, v in zip(made, values):
                    made[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made.values(), kinds)], names=list(made))

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, READ)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", extra), (-1, 1, "assistant", extra)], "conv_id long, turn long, role string, text string")
    rows = rows.unionByName(more).withColumn("parts", text_parts(F.col("text")))
    return read_back(format_conversations(conversations(rows)))


ORACLE = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(t, '([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>>|start_of_turn>|end_of_turn>)', '\\1\\\\\\2\\3', 'g') AS x FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(t) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN t END, '' ORDER BY turn NULLS FIRST, role, t), '')) AS loss_sha256,
       CAST(sum(12 + length(role) + 1 + length(x) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
