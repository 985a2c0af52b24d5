"""Error classes and ``key=value`` parameters of log messages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from proofline.functions.binding import let
from proofline.functions.text import SPACE, WORD, object_json

UNCLASSIFIED = "UNCLASSIFIED_ERROR"

# Message tokens after `ERR` and the class each one stands for.
ERROR_TOKENS = {
    "SMTPConnRefused": "SMTP_CONN_REFUSED",
    "PaymentDeclined": "PAYMENT_DECLINED",
    "ConnTimeout": "CONNECTION_TIMEOUT",
    "NullPointer": "NULL_POINTER",
}
# A gateway failure anywhere in the message.
GATEWAY_PHRASE = rf"(?<![{WORD}])HTTP[{SPACE}]+502(?![{WORD}])"
GATEWAY_CLASS = "HTTP_502"

_TOKEN = rf"(?d)^ERR[{SPACE}]+([A-Za-z][A-Za-z0-9_]*)(?![{WORD}])[{SPACE}]*(.*)$"
_PARAMETER = rf"([A-Za-z][A-Za-z0-9_]*)=([^{SPACE}]+)"


@dataclass(frozen=True)
class ErrorTaxonomy:
    """Which messages belong to which class; extend it to classify other products' logs."""

    tokens: dict[str, str] = field(default_factory=lambda: dict(ERROR_TOKENS))
    phrase: str = GATEWAY_PHRASE
    phrase_class: str = GATEWAY_CLASS


def classify(message: Column, taxonomy: ErrorTaxonomy) -> tuple[Column, Column]:
    """``(error class, details text)`` of an ERROR message; details is NULL when unclassified."""
    phrase = rf"(?d){taxonomy.phrase}[{SPACE}]*(.*)$"
    token = F.regexp_extract(message, _TOKEN, 1)
    lookup = F.create_map(*[F.lit(x) for pair in taxonomy.tokens.items() for x in pair])
    known = token.isin(*taxonomy.tokens)
    has_phrase = message.rlike(phrase)
    error_type = (
        F.when(known, F.element_at(lookup, token))
        .when(has_phrase, F.lit(taxonomy.phrase_class))
        .otherwise(F.lit(UNCLASSIFIED))
    )
    details = F.when(known, F.regexp_extract(message, _TOKEN, 2)).when(
        has_phrase, F.regexp_extract(message, phrase, 1)
    )
    return error_type, details


def parameter_pairs(details: Column) -> Column:
    """Sorted array of ``(key, value)``: of a repeated key the last value stays."""
    keys = F.regexp_extract_all(details, F.lit(_PARAMETER), F.lit(1))
    values = F.regexp_extract_all(details, F.lit(_PARAMETER), F.lit(2))
    placed = F.array_sort(
        F.zip_with(
            F.arrays_zip(keys.alias("key"), values.alias("value")),
            F.sequence(F.lit(1), F.greatest(F.size(keys), F.lit(1))),
            lambda p, i: F.struct(p["key"].alias("key"), i.alias("place"), p["value"].alias("value")),
        )
    )
    last = let(
        placed,
        lambda all_: F.filter(
            all_, lambda p, i: ~p["key"].eqNullSafe(F.get(all_, i + 1)["key"])
        ),
    )
    return F.when(
        F.size(keys) > 0,
        F.transform(last, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))),
    ).otherwise(F.array().cast("array<struct<key:string,value:string>>"))


def parameters_json(pairs: Column) -> Column:
    """Compact JSON object of the pairs; ``{}`` when there are none."""
    return F.when(F.size(pairs) > 0, object_json(pairs)).otherwise(F.lit("{}"))


def parameter(pairs: Column, name: str) -> Column:
    """Value of one parameter, NULL when absent."""
    return F.get(F.filter(pairs, lambda p: p["key"] == F.lit(name)), F.lit(0))["value"]
