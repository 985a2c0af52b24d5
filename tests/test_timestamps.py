import random
import re
from datetime import datetime, timezone

from pyspark.sql import functions as F

from proofline.functions.timestamps import iso_utc, parse_timestamp

SEEDS = [
    "2026-07-27T12:00:00Z",
    "2026-07-27T12:00:00+07:00",
    "20260727T120000Z",
    "2026-W30-1T12:00:00Z",
    "2026-W30T12:00Z",
    "2026W301T1200+07",
    "2026W30T12Z",
    "2026W01112Z",
    "2026-07-27 12:00:00.123456-0730",
    "2026-07-27T12:00:00,5Z",
    "2026-07-27",
    "2026-07-27T12",
    "2024-02-29T23:59:59.999999+23:59",
    "0001-01-01T00:00:00+01:00",
    "9999-12-31T23:59:59-01:00",
    "2020-W53-7T00:00Z",
    "2021-W53-1T00Z",
    "2026-07-27T12:00:00-07:00:30",
    "2026-07-27T12000055Z",
    "2026-07-27T12:00:00:123Z",
    "2026-07-27T24:00:00Z",
    "2026-07-27é12:00Z",
    "",
]


def expected(text):
    try:
        parsed = datetime.fromisoformat(text)
    except ValueError:
        return "invalid", None
    if parsed.tzinfo is None:
        return "naive", None
    if not re.search(r"(Z|[+-]\d{2}(?::?\d{2})?)\Z", text):
        return "invalid", None
    try:
        return "aware", parsed.astimezone(timezone.utc).isoformat()
    except OverflowError:
        return "invalid", None


def test_agrees_with_the_standard_parser_on_mutations(spark):
    rng = random.Random(11)
    texts = set(SEEDS)
    for seed in SEEDS:
        for _ in range(120):
            chars = list(seed)
            for _ in range(rng.choice([1, 1, 2])):
                spot = rng.randrange(len(chars) + 1)
                if rng.random() < 0.5:
                    chars.insert(spot, rng.choice("0123456789-+:.,TWZ x\n|é"))
                elif chars:
                    chars[spot % len(chars)] = rng.choice("0123456789-+:.,TWZ x")
            texts.add("".join(chars))
    frame = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    parsed = frame.withColumn("p", parse_timestamp("t")).select(
        "t", F.col("p.naive").alias("naive"), iso_utc(F.col("p.instant")).alias("at")
    )
    for row in parsed.collect():
        kind = "aware" if row["at"] else "naive" if row["naive"] else "invalid"
        assert (kind, row["at"]) == expected(row["t"]), row["t"]
