"""Conversations formatted by a compiled template, with the spans that a model has to learn, and read back.

Rows are brought together by conversation and sorted by turn within the tasks; a task then reads each conversation as a
stream of turns and writes it in parts of bounded size, cut between turns, so that no conversation is held whole.

Control strings inside texts are escaped: a mark is put behind the first character of a control string, and one more
where marks already stand, so that taking one mark off gives the text back and no control string is left in it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.template import CUT, END, START, Template, shown

BEGIN, OPEN, CLOSE, STOP = "<s>", "[INST]", "[/INST]", "</s>"

TEMPLATE = """{{ begin }}
{%- for message in messages -%}
    {{ open }}{{ message.role | plain }}{{ close }}
    {%- if message.role == 'assistant' -%}
        {% generation %}{{ message.text | plain }}{% endgeneration %}
    {%- else -%}
        {{ message.text | plain }}
    {%- endif -%}
    {{ stop }}
{%- endfor -%}"""

#: Code points after which a part of a conversation is closed, and of parts that are handed on together.
PART = 1 << 20
_BATCH = 4 << 20

FORMATTED = "id {id}, part long, formatted string, learnt array<struct<start:long,end:long>>"


class ChatFormat:
    """A template, its control strings, and the way back from its output.

    The template must write every turn as open, role, close, text, stop, the roles and texts through the filter
    ``plain``; what it writes before the first turn is up to it. Control strings start with one of a few characters that
    occur nowhere else in them.
    """

    def __init__(self, template: str = TEMPLATE, begin: str = BEGIN, open_: str = OPEN, close: str = CLOSE, stop: str = STOP):
        self.made_of = (template, begin, open_, close, stop)
        controls = [begin, open_, close, stop]
        first = "".join(sorted({c[0] for c in controls}))
        rest = sorted({c[1:] for c in controls}, key=lambda r: (-len(r), r))
        if any(not r or set(r) & (set(first) | {"\\"}) for r in rest):
            raise ValueError("a control string has a first character, which no control string repeats, and more")
        listed = "".join("\\" + c for c in first)
        self.marked = re.compile(rf"([{listed}])(\\*)({'|'.join(re.escape(r) for r in rest)})")
        self.open, self.close, self.stop = open_, close, stop
        constants = {"begin": begin, "open": open_, "close": close, "stop": stop}
        self.template = Template(template, constants, {"plain": lambda x: self.plain(shown(x))})

    def __reduce__(self) -> tuple:  # closures do not travel: each worker compiles the template
        return ChatFormat, self.made_of

    def plain(self, text: str) -> str:
        return self.marked.sub(r"\1\2\\\3", text)

    def restored(self, text: str) -> str:
        return self.marked.sub(lambda m: m[1] + m[2][1:] + m[3], text)

    def parts(self, messages: Iterable[dict], most: int = PART) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Text and learnt spans of each part."""
        out, spans, at, start = [], [], 0, 0
        for piece in self.template.pieces({"messages": messages}):
            if piece is START:
                start = at
            elif piece is END:
                spans.append((start, at))
            elif piece is not CUT:
                out.append(piece)
                at += len(piece)
            elif at >= most:
                yield "".join(out), spans
                out, spans, at = [], [], 0
        if out:
            yield "".join(out), spans

    def turns(self, part: str) -> Iterator[tuple[str, str]]:
        """Role and text of the turns of a part, read from its text alone."""
        at = part.find(self.open)
        while at >= 0:
            middle = part.index(self.close, at)
            end = part.index(self.stop, middle)
            yield self.restored(part[at + len(self.open) : middle]), self.restored(part[middle + len(self.close) : end])
            at = part.find(self.open, end)


DEFAULT = ChatFormat()


def _flow(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def format_conversations(
    rows: DataFrame, chat: ChatFormat = DEFAULT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(id, part, formatted, learnt)``: every conversation's text in numbered parts, and the learnt spans in code points.

    Turns are in the order of ``turn``, then role and text (null first); rows that repeat a turn are all written. A null
    role or text is empty, rows with a null identifier are one conversation. Nearly all conversations are one part; longer
    ones are cut between turns. The parts of a conversation follow each other within one partition. An empty table
    gives no row; other columns are ignored.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    told = rows.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    told = told.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, out, held = [pa.null()], ([], [], [], []), 0

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of[0] = batch.column(0).type
                yield batch

        def batch() -> pa.RecordBatch:
            kinds = of[0], pa.int64(), pa.string(), span
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["id", "part", "formatted", "learnt"])

        for identifier, turns in groupby(_flow(typed()), key=lambda r: r[0]):
            messages = ({"role": role or "", "text": text or ""} for _, role, text in turns)
            for number, (text, spans) in enumerate(chat.parts(messages)):
                for column, value in zip(out, (identifier, number, text, [{"start": s, "end": e} for s, e in spans])):
                    column.append(value)
                held += len(text)
                if held > _BATCH:
                    yield batch()
                    out, held = ([], [], [], []), 0
        if out[0]:
            yield batch()

    return told.mapInArrow(run, FORMATTED.format(id=kind))


def read_back(formatted: DataFrame, chat: ChatFormat = DEFAULT, ordered: bool = True) -> DataFrame:
    """``(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` per conversation, from its parts alone.

    With ``ordered`` the parts of a conversation stand together and in order within a partition, as
    ``format_conversations`` leaves them; else they are brought together first.
    """
    kind = formatted.schema["id"].dataType.simpleString()
    if not ordered:
        formatted = formatted.repartition("id").sortWithinPartitions("id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, out = [pa.null()], []

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of[0] = batch.column(0).type
                yield batch

        def batch() -> pa.RecordBatch:
            kinds = of[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for identifier, parts in groupby(_flow(typed()), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            count = learnt = length = 0
            for _, _, text, spans in parts:
                length += len(text)
                for role, said in chat.turns(text):
                    count += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for place in spans:
                    own = chat.restored(text[place["start"] : place["end"]])
                    learnt += len(own)
                    loss.update(own.encode())
            out.append((identifier, count, turns.hexdigest(), learnt, loss.hexdigest(), length))
            if len(out) >= 10_000:
                yield batch()
                out = []
        if out:
            yield batch()

    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return formatted.select("id", "part", "formatted", "learnt").mapInArrow(
        run, f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
