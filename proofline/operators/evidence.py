"""Inventories, manifests and verification: every check is a row saying what was expected."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.functions.fingerprints import bucket_fingerprints, bucket_of, fingerprint_of, lane_sums, row_hash
from proofline.operators.validation import ACTIONS
from proofline.sources.lines import file_fingerprints

# Buckets of keys that two tables are compared by before any of their rows are.
DIFF_BUCKETS = 1024
# What is checked of the link of an analysis, by the name of the check.
_LINKED = {"logic": "logic_sha256", "result": "result_fingerprint", "dataset": "dataset_fingerprint"}


def source_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Relative path, size and digest of every regular file below ``root``."""
    base = root.rstrip("/") + "/"
    return file_fingerprints(spark, root).select(
        F.regexp_replace("source_path", r"^.*?\Q" + base + r"\E", "").alias("path"),
        "byte_size",
        F.col("source_sha256").alias("sha256"),
    )


def inventory_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``path, before_sha256, after_sha256, status`` of two inventories ``path, sha256``."""
    joined = before.select("path", F.col("sha256").alias("before_sha256"), F.lit(True).alias("was")).join(
        after.select("path", F.col("sha256").alias("after_sha256"), F.lit(True).alias("now")), "path", "full"
    )
    return joined.select(
        "path",
        "before_sha256",
        "after_sha256",
        F.when(F.col("was").isNull(), F.lit("added"))
        .when(F.col("now").isNull(), F.lit("removed"))
        .when(F.col("before_sha256").eqNullSafe(F.col("after_sha256")), F.lit("same"))
        .otherwise(F.lit("changed"))
        .alias("status"),
    )


def inventory_agreement(inventories: Mapping[str, DataFrame]) -> DataFrame:
    """``path, present, missing, odd, status`` of all inventories ``path, sha256`` together, in one aggregation by path.

    ``present`` and ``missing`` name the inventories that list the path or don't; ``odd`` those whose digest is another than the
    one most of them have, if there is such a one.  The status is ``same``, ``missing``, ``changed``, both of them,
    or ``repeated`` where an inventory lists a path twice.
    """
    names = list(inventories)
    rows = _stack([inventories[n].select("path", F.coalesce("sha256", F.lit("")).alias("sha256"), F.lit(n).alias("name")) for n in names])
    of = lambda n, value: F.when(F.col("name") == n, value)
    listed = rows.groupBy("path").agg(
        *[F.max(of(n, F.col("sha256"))).alias(f"digest_{i}") for i, n in enumerate(names)],
        *[F.count(of(n, F.lit(1))).alias(f"rows_{i}") for i, n in enumerate(names)],
    )
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"digest_{i}").alias("digest")) for i, n in enumerate(names)])
    there = listed.withColumn("there", F.filter(cells, lambda c: c["digest"].isNotNull())).withColumn(
        "votes", F.transform("there", lambda c: F.size(F.filter("there", lambda o: o["digest"] == c["digest"])))
    )
    # A digest that more than half of those present have is the one most of them have.
    odd = F.filter(F.arrays_zip("there", "votes"), lambda z: z["votes"] * 2 < F.size("there"))
    has_most = F.exists("votes", lambda v: v * 2 > F.size("there"))
    name = lambda cells: F.transform(cells, lambda c: c["name"])
    is_missing = F.size("there") < len(names)
    is_changed = F.exists("votes", lambda v: v < F.size("there"))
    return there.select(
        "path",
        name(F.col("there")).alias("present"),
        F.filter(F.array(*map(F.lit, names)), lambda n: ~F.array_contains(name(F.col("there")), n)).alias("missing"),
        F.when(has_most, F.transform(odd, lambda z: z["there"]["name"])).otherwise(F.array().cast("array<string>")).alias("odd"),
        F.when(F.greatest(*[F.col(f"rows_{i}") for i in range(len(names))], F.lit(0)) > 1, "repeated")
        .when(is_missing & is_changed, "missing and changed")
        .when(is_missing, "missing")
        .when(is_changed, "changed")
        .otherwise("same")
        .alias("status"),
    )


def require_same_inventory(*inventories: DataFrame) -> None:
    """Fail when the inventories differ in membership or bytes."""
    named = {str(i): inventory for i, inventory in enumerate(inventories, 1)}
    row = inventory_agreement(named).filter(F.col("status") != "same").orderBy("path").first()
    if row is not None:
        raise ValueError(f"inventory differs: {row['path']} {row['status']}")


def measured(artifacts: Mapping[str, DataFrame], totals: Mapping[str, Mapping[str, Column]] | None = None) -> DataFrame:
    """``artifact, row_count, fingerprint, totals`` of named tables, each read once.

    ``totals`` gives aggregates of a table by name; they come from the same pass.
    """
    rows = []
    for name, frame in sorted(artifacts.items()):
        wanted = dict((totals or {}).get(name, {}))
        kept = frame.select(row_hash(frame).alias("_digest"), *frame.columns) if wanted else frame.select(row_hash(frame).alias("_digest"))
        sums = kept.agg(
            F.count(F.lit(1)).alias("row_count"), *lane_sums(F.col("_digest")), *[c.alias(f"total {n}") for n, c in wanted.items()]
        )
        cells = [F.struct(F.lit(n).alias("name"), F.col(f"total {n}").cast("long").alias("total")) for n in wanted]
        kind = "array<struct<name:string,total:long>>"
        rows.append(
            sums.select(
                F.lit(name).alias("artifact"),
                "row_count",
                fingerprint_of().alias("fingerprint"),
                (F.array(*cells) if cells else F.array()).cast(kind).alias("totals"),
            )
        )
    return _stack(rows)


def artifact_manifest(artifacts: Mapping[str, DataFrame]) -> DataFrame:
    """``artifact, row_count, fingerprint`` for named tables."""
    return measured(artifacts).drop("totals")


def analysis_links(manifest: DataFrame, logic: Mapping[str, str], dataset: str) -> DataFrame:
    """Each analysis result tied to the digest of its logic and to its input table."""
    rows = manifest.sparkSession.createDataFrame(sorted(logic.items()), "artifact string, logic_sha256 string")
    source = manifest.filter(F.col("artifact") == dataset).select("fingerprint").scalar()
    return manifest.join(rows, "artifact").select(
        F.col("artifact").alias("analysis_id"),
        "logic_sha256",
        F.col("fingerprint").alias("result_fingerprint"),
        F.col("row_count").alias("result_row_count"),
        source.alias("dataset_fingerprint"),
    )


@dataclass(frozen=True)
class Statement:
    """What a run says of its tables: a few stored rows, whatever the size of the tables."""

    tables: DataFrame
    links: DataFrame

    @property
    def manifest(self) -> DataFrame:
        return self.tables.drop("totals")

    @property
    def totals(self) -> DataFrame:
        """``name, total``: input, each action, actions outside the list, clean rows."""
        return self.tables.select(F.inline("totals"))


def state(
    artifacts: Mapping[str, DataFrame], logic: Mapping[str, str], root: str, ledger: str = "ledger", clean: str = "clean"
) -> Statement:
    """Read every table once and store what is to be said of it below ``root``."""
    spark = artifacts[clean].sparkSession
    root = root.rstrip("/")
    measured(artifacts, {ledger: ledger_aggregates(), clean: {"clean": F.count(F.lit(1))}}).write.parquet(f"{root}/tables")
    tables = spark.read.parquet(f"{root}/tables")
    analysis_links(tables.drop("totals"), logic, clean).write.parquet(f"{root}/links")
    return Statement(tables, spark.read.parquet(f"{root}/links"))


def run_fingerprint(manifest: DataFrame) -> DataFrame:
    """One row ``run_id``: the digest of the sorted manifest rows.

    A manifest has one row per published table, so gathering it is bounded by the code, not by data.
    """
    lines = F.concat_ws(" ", "artifact", F.col("row_count").cast("string"), "fingerprint")
    return manifest.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), "\n"), 256).alias("run_id"))


def _stack(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _check(name: Column, expected: Column, actual: Column) -> list[Column]:
    return [
        name.alias("check_name"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        F.coalesce(expected.cast("string") == actual.cast("string"), F.lit(False)).alias("ok"),
    ]


def ledger_aggregates() -> dict[str, Column]:
    """Totals of a ledger: input, each action, actions outside the list."""
    action = F.col("final_action")
    return {
        "input": F.count(F.lit(1)),
        **{a.lower(): F.count_if(action == a) for a in ACTIONS},
        "invalid_action": F.count_if(~F.coalesce(action.isin(*ACTIONS), F.lit(False))),
    }


def verify_manifest(published: Statement, live: Statement) -> DataFrame:
    """Check rows ``check_name, expected, actual, ok``: what was published against the tables as they are now.

    Counts and fingerprints of all artifacts; logic, result and dataset of every analysis; totals, conservation of rows, and
    the run's id.  Both statements are stored rows, so no table is read here.
    """
    now = live.manifest.select(
        "artifact", F.col("row_count").alias("live_count"), F.col("fingerprint").alias("live_fingerprint")
    )
    both = published.manifest.join(now, "artifact", "full")
    name = lambda kind, of: F.concat(F.lit(f"{kind} "), F.col(of))
    checked = [
        both.select(
            F.inline(
                F.array(
                    F.struct(*_check(name("row_count", "artifact"), F.col("row_count"), F.col("live_count"))),
                    F.struct(*_check(name("fingerprint", "artifact"), F.col("fingerprint"), F.col("live_fingerprint"))),
                )
            )
        )
    ]
    seen = live.links.select("analysis_id", *[F.col(c).alias(f"live_{c}") for c in _LINKED.values()])
    linked = published.links.join(seen, "analysis_id", "full")
    checked.append(
        linked.select(
            F.inline(
                F.array(*[F.struct(*_check(name(kind, "analysis_id"), F.col(c), F.col(f"live_{c}"))) for kind, c in _LINKED.items()])
            )
        )
    )
    totals = published.totals.withColumnRenamed("total", "published").join(live.totals, "name", "full")
    checked.append(totals.select(*_check(name("total", "name"), F.col("published"), F.col("total"))))
    # A handful of totals: pivoted by hand into one row for the two conservation checks.
    of = lambda *names: F.sum(F.when(F.col("name").isin(*names), F.col("total")).otherwise(0))
    sums = live.totals.agg(
        of("input").alias("input"),
        of("accept", "repair", "reject").alias("actions"),
        of("accept", "repair").alias("kept"),
        of("clean").alias("clean"),
    )
    checked.append(
        sums.select(
            F.inline(
                F.array(
                    F.struct(*_check(F.lit("conservation input = actions"), F.col("input"), F.col("actions"))),
                    F.struct(*_check(F.lit("conservation kept = clean"), F.col("kept"), F.col("clean"))),
                )
            )
        )
    )
    run = run_fingerprint(published.manifest).select(F.lit("run_id").alias("k"), F.col("run_id").alias("published"))
    live_run = run_fingerprint(live.manifest).select(F.lit("run_id").alias("k"), "run_id")
    checked.append(run.join(live_run, "k").select(*_check(F.col("k"), F.col("published"), F.col("run_id"))))
    return _stack(checked)


def require_verified(checks: DataFrame) -> None:
    """Fail with the first check that does not hold."""
    row = checks.filter(~F.col("ok")).orderBy("check_name").first()
    if row is not None:
        raise ValueError(f"{row['check_name']}: expected {row['expected']}, found {row['actual']}")


def reconstruction_diff(rebuilt: DataFrame, published: DataFrame, *key: str, buckets: int = DIFF_BUCKETS) -> DataFrame:
    """Rows of either table that have no equal row in the other, with how many copies are apart.

    Both tables are first reduced to one fingerprint per bucket of keys; only rows of buckets that differ
    are shuffled, as key and digest, and equal rows among them cancel out on the map side.  Tables that are equal shuffle no row.
    What comes to the driver is a set of bucket numbers.
    """
    published = published.select(*rebuilt.columns)
    prints = [bucket_fingerprints(frame, key, buckets) for frame in (rebuilt, published)]
    seen = _stack([p.select("bucket", F.struct("row_count", "fingerprint").alias("print")) for p in prints])
    # Two equal rows of a bucket, or it differs.
    apart = seen.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("print").alias("prints"))
    differing = sorted(r["bucket"] for r in apart.filter("n <> 2 or prints <> 1").select("bucket").collect())
    chosen = bucket_of(key, buckets).isin(differing) if differing else F.lit(False)
    side = lambda frame, sign: frame.filter(chosen).select(*key, row_hash(frame).alias("row_sha256"), F.lit(sign).alias("sign"))
    both = side(rebuilt, 1).unionByName(side(published, -1))
    return (
        both.groupBy(*key, "row_sha256")
        .agg(F.sum("sign").alias("difference"))
        .filter(F.col("difference") != 0)
        .withColumn("status", F.when(F.col("difference") > 0, F.lit("missing")).otherwise(F.lit("unexpected")))
        .withColumn("copies", F.abs("difference"))
        .drop("difference")
    )


def input_binding(descriptors: DataFrame, declared: DataFrame, live: DataFrame) -> DataFrame:
    """Check descriptors ``path, sha256`` of inputs against the declared and the live inventory.

    The digest must be 64 hexadecimal digits, the path relative and without upward steps, listed
    in both inventories, and all digests equal; the first rule that fails is reported.
    """
    joined = descriptors.join(
        declared.select("path", F.col("sha256").alias("declared_sha256")), "path", "left"
    ).join(live.select("path", F.col("sha256").alias("live_sha256")), "path", "left")
    outside = F.startswith("path", F.lit("/")) | F.array_contains(F.split("path", "/"), "..")
    return joined.withColumn(
        "status",
        F.when(F.col("path").isNull() | F.col("sha256").isNull(), F.lit("descriptor invalid"))
        .when(~F.col("sha256").rlike(r"\A[0-9a-f]{64}\z"), F.lit("hash mismatch"))
        .when(outside, F.lit("membership mismatch"))
        .when(F.col("declared_sha256").isNull() | F.col("live_sha256").isNull(), F.lit("membership mismatch"))
        .when(
            (F.col("declared_sha256") != F.col("sha256")) | (F.col("live_sha256") != F.col("sha256")),
            F.lit("hash mismatch"),
        )
        .otherwise(F.lit("ok")),
    )


def run_summary(parts: Mapping[str, DataFrame]) -> DataFrame:
    """``part, metric, value`` text rows from one-row tables of totals, one per part of a run."""
    blocks = []
    for part, totals in sorted(parts.items()):
        cells = [
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("string").alias("value"))
            for name in totals.columns
        ]
        blocks.append(totals.select(F.lit(part).alias("part"), F.inline(F.array(*cells))))
    return _stack(blocks)
