"""Strict JSON parsing: the library's Python step over rows, one Arrow pass over one or several text columns.

Spark's JSON readers accept trailing text, ``NaN`` and the like, so they cannot decide what is
malformed, and they do not keep number text apart (``1`` and ``1.0``).  The step below decides
exactly that and hands every value back as plain columns; all rules on top are native expressions.

``json_status`` is ``OBJECT``, ``NOT_OBJECT`` or ``MALFORMED`` (NULL for a NULL text).  Text that
parses but has no UTF-8 form (a lone surrogate), no finite number (``1e400``) or too many levels
counts as malformed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from proofline.schemas import EXTRA_FIELD

OBJECT, NOT_OBJECT, MALFORMED = "OBJECT", "NOT_OBJECT", "MALFORMED"
_KINDS = {
    type(None): "null",
    bool: "bool",
    int: "int",
    float: "float",
    str: "string",
    list: "array",
    dict: "object",
}
_ABSENT = object()


def _refuse_constant(name: str) -> None:
    raise ValueError(name)


def _comparable(value):
    """The value with numbers brought to one form, so that equal values have equal text."""
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        if value != value:
            raise ValueError("NaN equals nothing")
        return int(value) if value.is_integer() else value
    if isinstance(value, list):
        return [_comparable(item) for item in value]
    if isinstance(value, dict):
        return {key: _comparable(item) for key, item in value.items()}
    return value


@dataclass(frozen=True)
class Parse:
    """A column to be parsed, what its results' names begin with, and whether ``NaN`` and infinities are values."""

    column: str
    prefix: str = ""
    allow_constants: bool = False


def parse_objects(
    frame: DataFrame,
    text_column: str,
    fields: Sequence[str],
    *,
    allow_constants: bool = False,
    detail: bool = False,
) -> DataFrame:
    """Append the parse result of ``text_column`` to every row."""
    return parse_columns(frame, [Parse(text_column, "", allow_constants)], fields, detail)


def parse_columns(frame: DataFrame, wanted: Sequence[Parse], fields: Sequence[str], detail: bool = False) -> DataFrame:
    """Append the parse results of several columns to every row, in one pass.

    For each of ``fields``: ``<field>_kind`` (absent, null, bool, int, float, string, array,
    object) and ``<field>_value`` (the string itself, otherwise canonical JSON text).  With
    ``detail`` also ``<field>_equal`` (text that is equal for equal values) and ``<field>_shown``
    (display text).  ``canonical_json`` has sorted keys and no spaces; ``extra_fields`` lists the
    other keys in order.
    """
    added = [_result_fields(w.prefix, fields, detail) for w in wanted]
    schema = T.StructType(frame.schema.fields + [f for one in added for f in one])
    indices = [frame.columns.index(w.column) for w in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsers = [_Parser(fields, w.allow_constants, detail) for w in wanted]
        for batch in batches:
            arrays = [a for at, parser in zip(indices, parsers) for a in parser.columns(batch.column(at).to_pylist())]
            names = [*batch.schema.names, *(f.name for one in added for f in one)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=names)

    return frame.mapInArrow(run, schema)


def _result_fields(prefix: str, fields: Sequence[str], detail: bool) -> list[T.StructField]:
    suffixes = ("kind", "value", "equal", "shown") if detail else ("kind", "value")
    names = ["json_status", "canonical_json", *[f"{f}_{s}" for f in fields for s in suffixes]]
    added = [T.StructField(prefix + n, T.StringType()) for n in names]
    added.append(T.StructField(f"{prefix}extra_fields", T.ArrayType(EXTRA_FIELD)))
    if detail:
        added.append(T.StructField(f"{prefix}extra_shown", T.StringType()))
    return added


class _Parser:
    """Texts of one column to the arrays of its results."""

    extra_type = pa.list_(pa.struct([("field", pa.string()), ("value_json", pa.string())]))

    def __init__(self, fields: Sequence[str], allow_constants: bool, detail: bool) -> None:
        self.fields, self.known, self.detail = fields, frozenset(fields), detail
        self.width = 4 if detail else 2
        decoder = json.JSONDecoder(parse_constant=None if allow_constants else _refuse_constant)
        self.decode, self.scan = decoder.decode, decoder.scan_once
        self.encode = json.JSONEncoder(
            ensure_ascii=False, allow_nan=allow_constants, sort_keys=True, separators=(",", ":")
        ).encode

    def parse(self, text: str):
        try:
            value = self.whole(text)
            canonical = self.canonical(value)
            if not canonical.isascii():
                canonical.encode("utf-8")
        except (ValueError, RecursionError):
            return MALFORMED, None, None
        return (OBJECT if type(value) is dict else NOT_OBJECT), canonical, value

    def whole(self, text: str):
        """The value of a text; one that begins and ends with the value itself is not searched for white space."""
        try:
            value, end = self.scan(text, 0)
            if end == len(text):
                return value
        except StopIteration:
            pass
        return self.decode(text)

    def canonical(self, value) -> str:
        # Most records are strings throughout: they are put together without an encoder of their own.
        if type(value) is dict and all(type(v) is str for v in value.values()):
            return "{" + ",".join([f"{encode_basestring(k)}:{encode_basestring(value[k])}" for k in sorted(value)]) + "}"
        return self.encode(value)

    def describe(self, value) -> tuple:
        if value is _ABSENT:
            return ("absent", None, None, None)[: self.width]
        kind = _KINDS[type(value)]
        text = value if kind == "string" else self.encode(value)
        if not self.detail:
            return kind, text
        try:
            equal = self.encode(_comparable(value))
        except ValueError:
            equal = None
        return kind, text, equal, repr(value)

    def columns(self, texts: list[str | None]) -> list[pa.Array]:
        status: list = []
        canonicals: list = []
        cells: list[list[list]] = [[[] for _ in range(self.width)] for _ in self.fields]
        lanes = list(zip(self.fields, cells))
        extras: list = []
        extras_shown: list = []
        for text in texts:
            state, canonical, value = (None, None, None) if text is None else self.parse(text)
            status.append(state)
            canonicals.append(canonical)
            others: list = []
            if state == OBJECT:
                for field, cell in lanes:
                    found = value.get(field, _ABSENT)
                    if type(found) is str and not self.detail:
                        cell[0].append("string")
                        cell[1].append(found)
                    else:
                        for column, part in zip(cell, self.describe(found)):
                            column.append(part)
                if not self.known.issuperset(value):
                    others = [
                        {"field": key, "value_json": self.encode(value[key])}
                        for key in sorted(value)
                        if key not in self.known
                    ]
            else:
                for cell in cells:
                    for column in cell:
                        column.append(None)
            extras.append(others)
            if self.detail:
                extras_shown.append(repr([o["field"] for o in others]) if others else None)
        arrays = [pa.array(status, pa.string()), pa.array(canonicals, pa.string())]
        arrays += [pa.array(column, pa.string()) for cell in cells for column in cell]
        arrays.append(pa.array(extras, self.extra_type))
        if self.detail:
            arrays.append(pa.array(extras_shown, pa.string()))
        return arrays
