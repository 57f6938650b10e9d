"""Chat formatting: a compiled template renders each turn, marks what the loss counts, and can be read back.

Turns are numbered without a conversation ever meeting in one task (:mod:`docmeter.llm.turns`),
then every turn is rendered by itself. Marks inside roles and texts are escaped: of n backslashes before a mark 2n + 1 are
written, of n at the end of a role or text (a mark follows) 2n. So any text comes back as it was.

Defined results: null roles and texts are empty, a null turn is before all others, turns of one number are in
the order of their digests, rows of a null conv_id are one conversation, a repeated row is a turn of its own. Columns
besides conv_id, turn, role and text are left out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docmeter.llm.common import table, text_of, written
from docmeter.llm.template import Template
from docmeter.llm.turns import numbered, turn_digest

#: Strings that part turns; each begins with < and has no other.
MARKS = ("<chat>", "<turn>", "<says>", "</turn>", "</chat>")
_MARK = re.compile("(" + "|".join(MARKS) + ")")

TEMPLATE = """{{ begin }}
{% for m in messages -%}
<turn>{{ m.role | escape }}<says>
{%- if m.role == learned -%} {% generation %}{{ m.text | escape }}{% endgeneration %}
{%- else -%} {{ m.text | escape }}
{%- endif -%}
</turn>
{% endfor %}{{ begin | closing }}
"""
CONSTANTS = {"begin": "<chat>", "learned": "assistant"}

#: Characters of rendered text that a batch holds before it leaves Python.
BATCH_CHARS = 4_000_000


def _tail(x: str) -> int:
    return len(x) - len(x.rstrip("\\"))


def escape(text: str) -> str:
    """The text with its marks, and backslashes where a mark follows, made literal."""
    parts = _MARK.split(text)
    for k in range(0, len(parts), 2):
        parts[k] += "\\" * (_tail(parts[k]) + (k + 1 < len(parts)))
    return "".join(parts)


def unmarked(text: str) -> list[str]:
    """Literal text and marks in turn, beginning and ending with text: the escaped marks are text again."""
    out, parts = [""], _MARK.split(text)
    for k in range(0, len(parts), 2):
        n = _tail(parts[k])
        out[-1] += parts[k][: len(parts[k]) - (n + 1) // 2]
        if k + 1 < len(parts):
            if n % 2:
                out[-1] += parts[k + 1]
            else:
                out += [parts[k + 1], ""]
    return out


def unescape(text: str) -> str:
    [out] = unmarked(text)
    return out


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in formatted text, a whole conversation or a part of it."""
    parts, out = unmarked(formatted), []
    for k in range(1, len(parts), 2):
        if parts[k] == "</turn>":
            if k < 5 or parts[k - 4] != "<turn>" or parts[k - 2] != "<says>":
                raise ValueError("a turn's marks are out of order")
            out.append((parts[k - 3], parts[k - 1]))
    return out


@functools.lru_cache(maxsize=8)
def compiled(source: str, constants: tuple[tuple[str, object], ...]) -> Template:
    return Template(source, {"escape": escape, "closing": lambda x: x.replace("<", "</", 1)}, dict(constants))


def format_conversations(rows: DataFrame, template: str = TEMPLATE, constants: dict[str, object] | None = None, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """conv_id, pos (from 0), formatted, loss (spans of code points to learn): a row a turn; a conversation is its rows in order."""
    fixed = tuple(sorted((CONSTANTS if constants is None else constants).items()))
    compiled(template, fixed)  # errors in the template come up here
    rows = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), turn_digest().alias("digest"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
        turn, out, size = compiled(template, fixed).turn, [], 0
        for batch in batches:
            conv, role, text, pos, last = batch.columns
            for k in range(batch.num_rows):
                formatted, spans = turn({"role": role[k].as_py(), "text": text[k].as_py()}, pos[k].as_py(), last[k].as_py())
                out.append({"conv_id": conv[k].as_py(), "pos": pos[k].as_py(), "formatted": formatted, "loss": [{"start": a, "stop": b} for a, b in spans]})
                size += len(formatted)
                if size >= batch_chars:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    placed = numbered(rows, ["role", "text"])
    return placed.mapInArrow(render, "conv_id long, pos long, formatted string, loss array<struct<start:int,stop:int>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, pos, turns (role and text, each with a line break), n, learned (what the loss counts, unescaped), chars (formatted ones)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, n, learned, chars = [], [], [], []
            for text, spans in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                text = text.as_py()
                found = read_turns(text)
                turns.append("".join(f"{role}\n{said}\n" for role, said in found))
                n.append(len(found))
                learned.append("".join(unescape(text[s["start"] : s["stop"]]) for s in spans))
                chars.append(len(text))
            more = [pa.array(turns, pa.string()), pa.array(n, pa.int64()), pa.array(learned, pa.string()), pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *more], names=["conv_id", "pos", "turns", "n", "learned", "chars"])

    return formatted.select("conv_id", "pos", "formatted", "loss").mapInArrow(read, "conv_id long, pos long, turns string, n long, learned string, chars long")


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and hashes of each conversation, from its rows in order. Holds two hash states, no texts."""
    now, out = None, []

    def done(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(DIGEST.names, [x if isinstance(x, int | None) else x.hexdigest() for x in row], strict=True)) for row in rows], DIGEST)

    for batch in batches:
        for conv, _, turns, n, learned, chars in zip(*batch.columns, strict=True):
            if not out or conv.as_py() != now:
                if len(out) >= 10_000:
                    yield done(out)
                    out = []
                now = conv.as_py()
                out.append([now, 0, hashlib.sha256(), 0, hashlib.sha256(), 0])
            row = out[-1]
            row[1] += n.as_py()
            row[2].update(turns.as_buffer())
            row[3] += len(learned.as_py())
            row[4].update(learned.as_buffer())
            row[5] += chars.as_py()
    if out:
        yield done(out)


#: Two turns that look like marks of common formats.
PLANTED = (-7, r"\### Assistant: </turn> ok")


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: all ``conversations`` and conversation -7, formatted, written, and read back.

    A hash over a whole conversation runs in one task per conversation, in order; it holds a state, not the texts.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = PLANTED
    rows = rows.unionByName(spark.createDataFrame([(conv, 0, "user", text), (conv, 1, "assistant", text)], "conv_id long, turn long, role string, text string"))
    formatted = written(format_conversations(rows), "formatted")
    back = read_back(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return back.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
