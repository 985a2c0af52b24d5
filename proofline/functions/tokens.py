"""Search tokens: runs of letters and digits, case-folded, single diacritics removed.

The rule is that of the common ``unicode61`` tokenizer; characters added to Unicode after its
tables were made (version 6) follow their present category instead.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# What tokens are made of, once folded.
_INSIDE = r"[\p{L}\p{N}\p{Co}]"
_CODE_POINTS, _DELETED = 0x110000, 0xFFFFFFFF
# Bits of one page of Spark's bitmap aggregate, and bytes of the texts that are cut together (a text more).
_PAGE_BITS, _TEXT_BYTES = 32_768, 4 << 20

# Combining marks that vanish from a token instead of ending it.
_MARKS = (
    "\u0300\u0301\u0302\u0303\u0304\u0306\u0307\u0308\u0309\u030a\u030b\u030c"
    "\u030f\u0311\u031b\u0323\u0324\u0325\u0326\u0327\u0328\u032d\u032e\u0330\u0331"
)


def _fold(char: str) -> str:
    """Case-folded, then the Latin base letter where exactly one mark was on it."""
    folded = char.casefold()
    single = folded if len(folded) == 1 else char
    parts = unicodedata.normalize("NFD", single)
    if len(parts) == 2 and unicodedata.combining(parts[1]) and parts[0].isascii():
        return parts[0].lower()
    return single


@cache
def _fold_table() -> tuple[str, str]:
    pairs = [(chr(c), _fold(chr(c))) for c in range(0x41, 0x1F000) if chr(c).isalpha()]
    changed = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in changed), "".join(b for _, b in changed)


def tokens(text: Column) -> Column:
    """Array of tokens in order; plain ASCII text takes a cheaper way to the same result."""
    source, target = _fold_table()
    # Characters without a counterpart are deleted in the same pass.
    folded = F.translate(text, source + _MARKS, target)
    any_script = F.regexp_extract_all(folded, F.lit(f"{_INSIDE}+"), F.lit(0))
    ascii_only = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.when(text.rlike(r"^\p{ASCII}*\z"), ascii_only).otherwise(any_script)


@dataclass(frozen=True)
class TokenTables:
    """The rule of :func:`tokens` by code point: what a character becomes, and whether that is part of a token."""

    folded: np.ndarray
    inside: np.ndarray

    def cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """How many tokens each text has, and the tokens of all texts in order; no text is null."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        sizes, found = [np.zeros(0, np.int64)], [pa.array([], pa.string())]
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _TEXT_BYTES, "right")) - 1)
            some = self._cut(texts.buffers()[2][offsets[at] : offsets[to]] if offsets[to] > offsets[at] else b"", offsets[at : to + 1] - offsets[at])
            sizes.append(some[0])
            found.append(some[1])
            at = to
        return np.concatenate(sizes), pa.concat_arrays(found)

    def _cut(self, data: bytes | pa.Buffer, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        raw = bytes(data)
        try:
            characters = raw.decode()
        except UnicodeDecodeError:
            # What is no UTF-8 is no part of a token.
            parts = [raw[a:b].decode(errors="replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            raw, offsets = b"".join(parts), np.cumsum([0, *map(len, parts)])
            characters = raw.decode()
        leading = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80
        bounds = np.r_[0, np.cumsum(leading)][offsets]
        code = self.folded[np.frombuffer(characters.encode("utf-32-le"), np.uint32)]
        kept = code != _DELETED
        if not kept.all():
            bounds, code = np.r_[0, np.cumsum(kept)][bounds], code[kept]
        inside = self.inside[code]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]
        opens[heads] = inside[heads]
        starts = np.flatnonzero(opens)
        letters = code[inside]
        ends = np.r_[(np.cumsum(inside) - 1)[starts], len(letters)]
        if len(letters) and letters.max() >= 0x80:
            widths = 1 + (letters >= 0x80) + (letters >= 0x800) + (letters >= 0x10000)
            ends = np.r_[0, np.cumsum(widths)][ends]
            text = letters.tobytes().decode("utf-32-le").encode()
        else:
            text = letters.astype(np.uint8).tobytes()
        found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text))
        return np.diff(np.searchsorted(starts, bounds)), found


@lru_cache(maxsize=1)
def token_tables(spark: SparkSession) -> TokenTables:
    """The tables of the rule; Spark's own regular expressions say what is part of a token, so that both ways agree."""
    source, target = _fold_table()
    folded = np.arange(_CODE_POINTS, dtype=np.uint32)
    folded[[ord(c) for c in source]] = [ord(c) for c in target]
    folded[[ord(c) for c in _MARKS]] = _DELETED
    character = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    points = spark.range(_CODE_POINTS).filter("id < 55296 or id > 57343").filter(character.rlike(f"^{_INSIDE}\\z"))
    pages = points.groupBy(F.expr(f"id div {_PAGE_BITS}").alias("page")).agg(F.bitmap_construct_agg(F.col("id") % _PAGE_BITS).alias("bits"))
    inside = np.zeros(_CODE_POINTS, bool)
    for row in pages.collect():
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        inside[row["page"] * _PAGE_BITS : (row["page"] + 1) * _PAGE_BITS] = bits[: _CODE_POINTS - row["page"] * _PAGE_BITS]
    return TokenTables(folded, inside)
