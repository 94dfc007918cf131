"""Problem 4: rows that fail to parse.

A line is parsed at least cost by dynamic programming over its quotes, delimiters and the runs between them: quotes may
be inserted or deleted at the cost QUOTE, delimiters at the cost DELIMITER, which is so much less that the quoting is
repaired with as few edits as possible before fields are counted. A line of zero cost whose fields have their types
loads. Else the edits tell the reason: those of quotes `quoting`, those of delimiters alone `columns`, and where there
are none it is the first field that isn't valid.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = 5
#: An edit of a quote costs more than any number of edits of delimiters.
QUOTE, DELIMITER = 1 << 40, 1
INT_MAX = 2_147_483_647
OUT = "line_key {key}, reason string, edits string, quote_edits int, delimiter_edits int, srt_index int, start_ms bigint, end_ms bigint, speaker string, seg_text string"

_TIME = re.compile(r"([0-9]{2}):([0-5][0-9]):([0-5][0-9])[.,]([0-9]{3})")
_INDEX = re.compile(r"[ \t ]*0*([0-9]{1,10})[ \t ]*")
_PLAIN = {d: re.compile(rf'"(?:[^"]|"")*"|[^"{d}]*') for d in (",", "\t")}
# Characters with no picture of their own outside the categories of blanks, controls and formats.
_NO_PICTURE = frozenset("͏ᅟᅠ឴឵⠀ㅤﾠ")


def visible(text: str) -> bool:
    """Whether anything in the text can be seen."""
    return any(not (c in _NO_PICTURE or "︀" <= c <= "️" or unicodedata.category(c) in ("Zs", "Zl", "Zp", "Cc", "Cf", "Cn")) for c in text)


def zero_cost(line: str, delimiter: str) -> list[str] | None:
    """The fields of a line that parses at no cost, else None.

    Without edits each piece leads from one state of the parse to one other, so this layer of the dynamic programme is
    followed by a pattern.
    """
    if '"' not in line:
        fields = line.split(delimiter)
        return fields if len(fields) == FIELDS else None
    fields, at, n, field = [], 0, len(line), _PLAIN[delimiter]
    while True:
        m = field.match(line, at)
        end = m.end()
        fields.append(m.group()[1:-1].replace('""', '"') if line.startswith('"', at) else m.group())
        if end == n:
            return fields if len(fields) == FIELDS else None
        if line[end] != delimiter:
            return None
        at = end + 1


# States of the parse: at the head of a field, in a bare field, in a quoted field, after the quote that closed it.
_HEAD, _BARE, _QUOTED, _CLOSED = range(4)
#: What a piece does to a state: (next state, edit or "").
_STEPS = {
    '"': {
        _HEAD: [(_QUOTED, ""), (_HEAD, 'delete"')],
        _BARE: [(_BARE, 'delete"')],
        # Closes, or stands for itself if another is put beside it.
        _QUOTED: [(_CLOSED, ""), (_QUOTED, 'insert"'), (_QUOTED, 'delete"')],
        # The second of two that stand for one.
        _CLOSED: [(_QUOTED, ""), (_CLOSED, 'delete"')],
    },
    # The closing quote before a run of text becomes one of two.
    "text": {_HEAD: [(_BARE, ""), (_QUOTED, 'insert"')], _BARE: [(_BARE, "")], _QUOTED: [(_QUOTED, "")], _CLOSED: [(_QUOTED, 'insert"')]},
    # Without "next" the delimiter is part of a quoted field. Else it ends the field, at no cost while fields are wanted.
    "delimiter": {_HEAD: [(_HEAD, "next"), (_QUOTED, 'insert"')], _BARE: [(_HEAD, "next")], _QUOTED: [(_QUOTED, ""), (_HEAD, 'insert" next')], _CLOSED: [(_HEAD, "next")]},
}


def least_edits(line: str, delimiter: str) -> tuple[int, list[tuple[str, int]]]:
    """Cost and edits of the cheapest parse into FIELDS fields, as (insert" or delete" or insert, or delete, and offset).

    A state is where the parse stands in a field and which field that is. A delimiter beyond the last field is deleted,
    and its field with it as part of the one before; those that lack at the end are inserted there. Equal costs
    prefer what comes first in _STEPS.
    """
    pieces = [(m.start(), m.group()) for m in re.finditer(rf'"|{delimiter}|[^"{delimiter}]+', line)]
    cost: dict[tuple[int, int], int] = {(_HEAD, 0): 0}
    back: list[dict[tuple[int, int], tuple[tuple[int, int], str]]] = []
    for _, piece in pieces:
        steps = _STEPS['"' if piece == '"' else "delimiter" if piece == delimiter else "text"]
        best: dict[tuple[int, int], int] = {}
        came: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
        for (state, field), c in cost.items():
            for to, edit in steps[state]:
                at, total = field, c + (QUOTE if '"' in edit else 0)
                if edit.endswith("next"):
                    edit = edit[:-4].strip()
                    if field + 1 < FIELDS:
                        at += 1
                    else:
                        total += DELIMITER
                        edit = f"{edit} delete{delimiter}" if edit else f"delete{delimiter}"
                if total < best.get((to, at), total + 1):
                    best[to, at], came[to, at] = total, ((state, field), edit)
        cost = best
        back.append(came)
    ends = {(s, f): c + (QUOTE if s == _QUOTED else 0) + DELIMITER * (FIELDS - 1 - f) for (s, f), c in cost.items()}
    now = min(ends, key=lambda k: (ends[k], k))
    total, n = ends[now], len(line)
    edits = [(f"insert{delimiter}", n)] * (FIELDS - 1 - now[1])
    if now[0] == _QUOTED:
        edits.insert(0, ('insert"', n))
    for (at, _), came in zip(reversed(pieces), reversed(back)):
        now, edit = came[now]
        if edit:
            edits[:0] = [(e, at) for e in re.findall(rf'(?:insert|delete)["{delimiter}]', edit)]
    return total, edits


def _ms(code: str) -> int | None:
    m = _TIME.fullmatch(code)
    return None if m is None else ((int(m[1]) * 60 + int(m[2])) * 60 + int(m[3])) * 1000 + int(m[4])


def parse_line(line: str | None, delimiter: str) -> tuple:
    """(reason, edits, quote_edits, delimiter_edits, index, start_ms, end_ms, speaker, text); reason is None for a good line.

    A NULL line has no fields: its reason is columns.
    """
    bad = lambda reason, edits=(): (reason, "; ".join(f"{e} {at}" for e, at in edits), sum(e[-1] == '"' for e, _ in edits), sum(e[-1] == delimiter for e, _ in edits), None, None, None, None, None)
    if line is None:
        return bad("columns", [(f"insert{delimiter}", 0)] * (FIELDS - 1))
    if line.endswith("\r"):
        line = line[:-1]
    fields = zero_cost(line, delimiter)
    if fields is None:
        cost, edits = least_edits(line, delimiter)
        return bad("quoting" if cost >= QUOTE else "columns", edits)
    index, start, end, speaker, text = fields
    number = _INDEX.fullmatch(index)
    if number is None or int(number[1]) > INT_MAX:
        return bad("index")
    if (start_ms := _ms(start)) is None:
        return bad("start")
    if (end_ms := _ms(end)) is None:
        return bad("end")
    if end_ms <= start_ms:
        return bad("order")
    if not visible(text):
        return bad("text")
    return None, "", 0, 0, int(number[1]), start_ms, end_ms, speaker or None, text


def parse_rows(df: DataFrame, key: str = "line_id", line: str = "raw_line", kind: str = "file_format") -> DataFrame:
    """key, reason, edits, their numbers and the typed fields of every line; reason is NULL where the line is good.

    kind is csv or tsv in any case; any other or NULL kind counts as csv. NULL lines have the reason columns,
    empty ones too. Every row is parsed on its own, so nothing is shuffled and no group can be too large.
    """
    schema = OUT.format(key=df.schema[key].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lines, kinds = (c.to_pylist() for c in batch.columns)
            parsed = [parse_line(x, "\t" if (k or "").lower() == "tsv" else ",") for x, k in zip(lines, kinds)]
            columns = list(zip(*parsed)) or [()] * 9
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]]
            yield pa.RecordBatch.from_arrays(arrays, ["line_key", "reason", "edits", "quote_edits", "delimiter_edits", "srt_index", "start_ms", "end_ms", "speaker", "seg_text"])

    return df.select(key, line, kind).mapInArrow(run, schema).withColumnRenamed("line_key", key)


def split_rows(df: DataFrame, key: str = "line_id") -> tuple[DataFrame, DataFrame]:
    """(good rows with typed fields, bad rows with reason and edits)."""
    parsed = parse_rows(df, key)
    good = parsed.where(F.col("reason").isNull()).drop("reason", "edits", "quote_edits", "delimiter_edits")
    return good, parsed.where(F.col("reason").isNotNull()).select(key, "reason", "edits", "quote_edits", "delimiter_edits")
