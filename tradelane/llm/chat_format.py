r"""Chat formatting of typed content parts.

A turn is a role and a list of parts: text, image, audio or document. A visitor flattens the
parts in order: text is escaped, every other part becomes a numbered placeholder
``<|image:1|>`` and is recorded with its reference and the tokens it expands to (images by
tiles, audio by seconds, documents by pages). A turn is written as

    ### role: content</turn>\n

Inside roles and texts a backslash goes before ``\``, ``#``, ``<`` and ``:``, so no control
string can appear there and reading back is exact.

Conversations are formatted and read back turn by turn in order, each with a running hash, so
a conversation of any length needs the memory of one turn; its hash is sequential by
definition, which is why one task reads a whole conversation.

Null roles and texts are empty. Turns come by (turn, role, text), nulls first, repeated rows
as often as they occur. A null conversation id is an id of its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import read

OPEN, CLOSE = "### ", "</turn>\n"
IMAGE_TILE, IMAGE_TOKENS = 512, 256
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 800

_ESCAPE = re.compile(r"[\\#<:]")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_HOLDER = re.compile(r"<\|(\w+)\\:(\d+)\|>")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits parts; keeps the attachments met, in order."""

    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> str:
        return getattr(self, f"visit_{part.get('type') or 'text'}")(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        tiles = math.ceil((part.get("width") or 1) / IMAGE_TILE) * math.ceil((part.get("height") or 1) / IMAGE_TILE)
        return self._hold("image", part, tiles * IMAGE_TOKENS)

    def visit_audio(self, part: dict) -> str:
        return self._hold("audio", part, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> str:
        return self._hold("document", part, (part.get("pages") or 1) * DOCUMENT_TOKENS_PER_PAGE)

    def _hold(self, kind: str, part: dict, tokens: int) -> str:
        number = len(self.attachments) + 1
        self.attachments.append({"number": number, "type": kind, "ref": part.get("ref"), "tokens": tokens})
        return f"<|{kind}\\:{number}|>"


@dataclass
class Turn:
    text: str
    #: The assistant's content in ``text``, as (start, end); ``None`` for other roles.
    loss: tuple[int, int] | None


def format_turn(role: str | None, parts: Iterable[dict], flat: Flattener) -> Turn:
    head = OPEN + escape(role or "") + ": "
    content = "".join(map(flat.visit, parts))
    loss = (len(head), len(head) + len(content)) if role == "assistant" else None
    return Turn(head + content + CLOSE, loss)


def read_turn(text: str) -> tuple[str, str]:
    """Role and content of a formatted turn; placeholders stay as they are."""
    if not (text.startswith(OPEN) and text.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    role = re.match(r"(?:[^\\:]|\\.)*", text[len(OPEN) :], re.DOTALL)[0]
    content = text[len(OPEN) + len(role) + 2 : -len(CLOSE)]
    pieces, last = [], 0
    for m in _HOLDER.finditer(content):
        if (len(content[: m.start()]) - len(content[: m.start()].rstrip("\\"))) % 2 == 0:
            pieces += [unescape(content[last : m.start()]), m[0]]
            last = m.end()
    return unescape(role), "".join([*pieces, unescape(content[last:])])


PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
SUMMARY = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_attachments bigint, attachment_tokens bigint"
)


def formatted(rows: Iterator[dict], state: dict | None = None) -> Iterator[dict]:
    """Turns of sorted rows (``conv_id, turn, role, parts``) in the template."""
    state = state if state is not None else {}
    for row in rows:
        if not state or state["id"] != row["conv_id"]:
            state.clear()
            state.update(id=row["conv_id"], flat=Flattener())
        flat = state["flat"]
        before = len(flat.attachments)
        turn = format_turn(row["role"], row["parts"] or [], flat)
        new = flat.attachments[before:]
        yield {"conv_id": row["conv_id"], "turn": row["turn"], "formatted": turn.text,
               "loss": list(turn.loss) if turn.loss else None, "attachments": new}


FORMATTED = (
    "conv_id bigint, turn bigint, formatted string, loss array<int>, "
    "attachments array<struct<number:int,type:string,ref:string,tokens:int>>"
)


def in_order(turns: DataFrame) -> DataFrame:
    columns = ["conv_id", "turn", "role", "parts"]
    text = F.col("parts").getItem(0)["text"]
    return turns.select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", text)


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, parts`` to one formatted row per turn, with its loss span and attachments."""
    shape = _arrow(FORMATTED)

    def run(batches):
        state: dict = {}
        for batch in batches:
            yield pa.RecordBatch.from_pylist(list(formatted(iter(batch.to_pylist()), state)), shape)

    return in_order(turns).mapInArrow(run, FORMATTED)


def read_back(turns: DataFrame) -> DataFrame:
    """What formatted conversations say when read again, one row per conversation.

    Works on ``format_conversations`` output while its turns are still in order.
    """
    shape = _arrow(SUMMARY)

    def close(s: dict) -> dict:
        return {"conv_id": s["id"], "n_turns": s["n"], "turns_sha256": s["turns"].hexdigest(), "loss_chars": s["loss_n"],
                "loss_sha256": s["loss"].hexdigest(), "formatted_chars": s["chars"], "n_attachments": s["held"],
                "attachment_tokens": s["tokens"]}

    def run(batches):
        s: dict = {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not s or s["id"] != row["conv_id"]:
                    if s:
                        out.append(close(s))
                    s = {"id": row["conv_id"], "n": 0, "chars": 0, "loss_n": 0, "held": 0, "tokens": 0,
                         "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                role, text = read_turn(row["formatted"])
                s["n"] += 1
                s["chars"] += len(row["formatted"])
                s["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if row["loss"]:
                    masked = unescape(row["formatted"][row["loss"][0] : row["loss"][1]])
                    s["loss_n"] += len(masked)
                    s["loss"].update(masked.encode("utf-8", "surrogatepass"))
                s["held"] += len(row["attachments"])
                s["tokens"] += sum(a["tokens"] for a in row["attachments"])
            if out:
                yield pa.RecordBatch.from_pylist(out, shape)
        if s:
            yield pa.RecordBatch.from_pylist([close(s)], shape)

    return turns.mapInArrow(run, SUMMARY)


def text_parts(column: str = "text"):
    return F.array(
        F.struct(
            F.lit("text").alias("type"), F.coalesce(column, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        )
    )


#: The conversation that its contract adds: -7.
HARD = r"\### Assistant: </turn> ok"


def op5_chat_formatting(spark, sf_dir) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    rows = read(spark, sf_dir, "conversations").select(columns)
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD).alias("text"),
    )
    turns = rows.unionByName(extra).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text_parts().alias("parts"))
    return read_back(format_conversations(turns))


_ESCAPED = r"length(regexp_replace({0}, '[\\#<:]', '\\\0', 'g'))"
SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{HARD}' UNION ALL SELECT -7, 1, 'assistant', '{HARD}'),
o AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum({len(OPEN) + 2 + len(CLOSE)} + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM o GROUP BY conv_id
"""
