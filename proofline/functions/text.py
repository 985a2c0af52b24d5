"""String expressions with Unicode-aware whitespace, and JSON text building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the rules treat as white space (inside a regex class).
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A letter or digit in any script, or an underscore (inside a regex class).
WORD = r"\p{L}\p{N}_"


# The same characters as a string, for the trimming functions.
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(col: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def rstrip(col: Column) -> Column:
    """Remove white space at the end."""
    return F.rtrim(col, F.lit(SPACE_CHARS))


def word_count(col: Column) -> Column:
    """Number of runs of characters that are not white space."""
    # Visible ASCII first: it decides most characters without walking the whole class.
    return F.regexp_count(col, F.lit(rf"[!-~[^{SPACE}]]+")).cast("long")


def quote_json(col: Column) -> Column:
    """JSON string text of ``col``: non-ASCII kept, control characters as lower-case escapes."""
    quoted = F.btrim(F.to_json(F.array(col)), F.lit("[]"))
    # Spark writes the hexadecimal letters of rare control characters in upper case.
    lowered = quoted
    for letter in "ABCDEF":
        lowered = F.regexp_replace(
            lowered, rf"(?<!\\)((?:\\\\)*)\\u00([01]){letter}", rf"$1\\u00$2{letter.lower()}"
        )
    # Visible ASCII without a quotation mark or a backslash stands as it is.
    plain = F.when(col.rlike(r"\A[ !#-\[\]-~]*\z"), F.concat(F.lit('"'), col, F.lit('"')))
    return plain.when(col.rlike(r"[\x0b\x0e\x0f\x1a-\x1f]"), lowered).otherwise(quoted)


def object_json(pairs: Column) -> Column:
    """JSON object text from an array of ``(key, value)`` string structs, in array order."""
    members = F.transform(
        pairs, lambda p: F.concat(quote_json(p["key"]), F.lit(":"), quote_json(p["value"]))
    )
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
