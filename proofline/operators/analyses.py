"""Customer analyses over the clean records and the ledger."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions.messages import UNCLASSIFIED
from proofline.functions.text import quote_json
from proofline.operators.ledger import require_columns
from proofline.operators.validation import ACTIONS


def _rows(frame: DataFrame) -> Column:
    """Row count of a frame that may already be counted in a column ``n``."""
    return F.sum("n") if "n" in frame.columns else F.count(F.lit(1))


def error_rollup(clean: DataFrame) -> DataFrame:
    """ERROR rows counted by day, service and class: all three error analyses can start here."""
    return (
        clean.filter(F.col("level") == "ERROR")
        .groupBy("level", "event_date_utc", "service", "error_type")
        .agg(_rows(clean).alias("n"))
    )


def service_error_counts(clean: DataFrame, level: str = "ERROR") -> DataFrame:
    """Rows of one level per service, ranked by count, then name."""
    counts = (
        clean.filter(F.col("level") == level)
        .groupBy("service")
        .agg(_rows(clean).cast("long").alias("error_count"))
    )
    # A service's rank: how many have a greater count, then its place among those with the same one.  Of counts there are few, so
    # no window holds all services.
    greater = Window.orderBy(F.desc("error_count")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.groupBy("error_count").agg(F.count(F.lit(1)).alias("services")).select(
        "error_count", F.coalesce(F.sum("services").over(greater), F.lit(0)).alias("ahead")
    )
    place = F.row_number().over(Window.partitionBy("error_count").orderBy("service"))
    return counts.join(ahead, "error_count").select(
        (F.col("ahead") + place).cast("long").alias("rank"), "service", "error_count"
    )


def daily_error_counts(
    clean: DataFrame,
    first_day: datetime.date | None = None,
    last_day: datetime.date | None = None,
) -> DataFrame:
    """Errors per calendar day with the median over all days and a flag above twice the median.

    Days without errors count zero.  Without bounds the calendar runs from the first to the last
    day that has an error.
    """
    by_service = (
        clean.filter(F.col("level") == "ERROR")
        .groupBy("event_date_utc", "service")
        .agg(_rows(clean).alias("service_errors"))
    )
    daily = by_service.groupBy("event_date_utc").agg(F.sum("service_errors").alias("errors"))
    # From here on there is one row per day.
    if (first_day is None) != (last_day is None):
        raise ValueError("give both calendar bounds or neither")
    if first_day is None:
        following = F.lead("event_date_utc").over(Window.orderBy("event_date_utc"))
        until = F.coalesce(F.date_sub(following, 1), F.col("event_date_utc"))
        filled = daily.withColumn("until", until).withColumn(
            "day", F.explode(F.sequence("event_date_utc", "until"))
        )
        own = F.col("day") == F.col("event_date_utc")
        days = filled.select(
            "day",
            F.when(own, F.col("errors")).otherwise(F.lit(0)).alias("errors"),
        )
    else:
        calendar = clean.sparkSession.range(1).select(
            F.explode(F.sequence(F.lit(first_day), F.lit(last_day))).alias("event_date_utc")
        )
        days = calendar.join(daily, "event_date_utc", "left").select(
            F.col("event_date_utc").alias("day"),
            F.coalesce("errors", F.lit(0)).alias("errors"),
        )
    scored = days.withColumn("median_error_count", F.median("errors").over(Window.partitionBy()))
    unusual = F.col("errors") > 2 * F.col("median_error_count")
    # Services are gathered for unusual days only.
    shown = by_service.join(scored.filter(unusual).select(F.col("day").alias("event_date_utc")), "event_date_utc", "left_semi")
    parts = F.array_sort(F.collect_list(F.struct("service", "service_errors")))
    listed = shown.groupBy(F.col("event_date_utc").alias("day")).agg(
        F.array_join(
            F.transform(parts, lambda p: F.concat(p["service"], F.lit(":"), p["service_errors"].cast("string"))),
            ";",
        ).alias("by_service"),
    )
    return scored.join(listed, "day", "left").select(
        F.col("day").alias("event_date_utc"),
        F.col("errors").cast("long").alias("daily_error_count"),
        "median_error_count",
        (F.col("errors") / F.nullif("median_error_count", F.lit(0.0))).alias("error_count_to_median_ratio"),
        unusual.alias("is_unusual_by_2x_median_rule"),
        F.when(unusual, F.coalesce("by_service", F.lit(""))).otherwise(F.lit("")).alias("service_contributions"),
    )


def top_error_types(clean: DataFrame, k: int = 3) -> DataFrame:
    """The k most frequent error classes, their services, and the unclassified total on each row."""
    by_service = (
        clean.filter(F.col("level") == "ERROR")
        .groupBy("error_type", "service")
        .agg(_rows(clean).alias("service_errors"))
    )
    by_type = by_service.groupBy("error_type").agg(F.sum("service_errors").cast("long").alias("error_count"))
    # One row per class: windows without a partition are small from here on.
    unclassified = F.sum(
        F.when(F.col("error_type") == UNCLASSIFIED, F.col("error_count")).otherwise(F.lit(0))
    ).over(Window.partitionBy())
    order = (F.desc("error_count"), F.asc("error_type"))
    top = (
        by_type.withColumn("unclassified_error_count", unclassified.cast("long"))
        .orderBy(*order)
        .limit(k)
    )
    # Services are gathered for the top classes only.
    parts = F.array_sort(F.collect_list(F.struct("service", "service_errors")))
    members = F.transform(
        parts, lambda p: F.concat(quote_json(p["service"]), F.lit(":"), p["service_errors"].cast("string"))
    )
    listed = by_service.join(F.broadcast(top.select("error_type")), "error_type", "left_semi").groupBy("error_type").agg(
        F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("service_contributions_json")
    )
    return (
        top.join(listed, "error_type", "left").withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
        .filter(F.col("error_type").isNotNull())
        .select("rank", "error_type", "error_count", "service_contributions_json", "unclassified_error_count")
    )


def quality_reconciliation(ledger: DataFrame, clean: DataFrame) -> DataFrame:
    """Record totals, issue occurrences and the two conservation rows, in display order.

    The ledger is read once: every line contributes one record count and, per distinct issue code
    and action, its occurrences.  All later steps work on the handful of resulting groups.
    """
    kinds = F.transform(
        "issues",
        lambda i: F.struct(
            F.lit("issue_occurrence").alias("metric_type"),
            i["issue_code"].alias("issue_code"),
            i["action"].alias("final_action"),
        ),
    )
    own = F.struct(
        F.lit("record_total").alias("metric_type"),
        F.lit(None).cast("string").alias("issue_code"),
        F.col("final_action"),
    )
    # A line is one physical row of the ledger, so its first mention of a code counts the record.
    entries = ledger.select("final_action", F.concat(F.array(own), kinds).alias("kinds")).select(
        F.posexplode_outer("kinds").alias("at", "kind"), "kinds"
    )
    first_mention = F.array_position("kinds", F.col("kind")) == F.col("at") + 1
    groups = entries.groupBy("kind.metric_type", "kind.issue_code", "kind.final_action").agg(
        F.count_if(first_mention).alias("records"), F.count(F.lit(1)).alias("mentions")
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    record = F.col("metric_type") == "record_total"
    known, kept = F.col("final_action").isin(*ACTIONS), F.col("final_action").isin("ACCEPT", "REPAIR")
    shape = ("metric_type", "issue_code", "final_action", "record_count", "issue_occurrences")

    def cell(metric, code, action, records, mentions):
        return F.struct(*[c.alias(n) for c, n in zip((metric, code, action, records, mentions), shape)])

    no_code = F.lit(None).cast("string")
    conserved = F.lit("conservation")
    from_ledger = groups.select(
        F.inline(
            F.when(
                record,
                F.array(
                    cell(F.col("metric_type"), no_code, F.col("final_action"), F.col("records"), zero),
                    cell(
                        conserved,
                        no_code,
                        F.lit("INPUT_EQUALS_ACTIONS"),
                        F.col("records"),
                        F.when(known, F.col("records")).otherwise(zero),
                    ),
                    cell(
                        conserved,
                        no_code,
                        F.lit("ANALYTICAL_EQUALS_PARQUET"),
                        F.when(kept, F.col("records")).otherwise(zero),
                        zero,
                    ),
                ),
            ).otherwise(
                F.array(
                    cell(
                        F.col("metric_type"),
                        F.col("issue_code"),
                        F.col("final_action"),
                        F.col("records"),
                        F.col("mentions"),
                    )
                )
            )
        )
    )
    from_clean = clean.agg(F.count(F.lit(1)).alias("n")).select(
        conserved.alias("metric_type"),
        no_code.alias("issue_code"),
        F.lit("ANALYTICAL_EQUALS_PARQUET").alias("final_action"),
        zero.alias("record_count"),
        F.col("n").alias("issue_occurrences"),
    )
    empty = ledger.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[cell(F.lit("record_total"), no_code, F.lit(a), zero, zero) for a in ACTIONS],
                cell(conserved, no_code, F.lit("INPUT_EQUALS_ACTIONS"), zero, zero),
            )
        )
    )
    total = (
        from_ledger.unionByName(from_clean)
        .unionByName(empty)
        .groupBy("metric_type", "issue_code", "final_action")
        .agg(F.sum("record_count").alias("record_count"), F.sum("issue_occurrences").alias("mentions"))
        .filter((F.col("metric_type") != "record_total") | known)
    )
    metric = F.col("metric_type")
    return (
        total.select(
            "metric_type",
            "issue_code",
            "final_action",
            F.col("record_count").cast("long").alias("record_count"),
            F.when(metric == "record_total", none).otherwise(F.col("mentions")).alias("issue_occurrences"),
            F.when(metric == "conservation", F.col("record_count") == F.col("mentions")).alias("is_reconciled"),
        )
        .orderBy(
            F.array_position(F.array(*[F.lit(m) for m in ("record_total", "issue_occurrence", "conservation")]), metric),
            F.array_position(F.array(*[F.lit(a) for a in (*ACTIONS, "INPUT_EQUALS_ACTIONS")]), F.col("final_action"))
            * F.when(metric == "record_total", 1).otherwise(0),
            F.when(metric == "conservation", F.col("final_action") == "ANALYTICAL_EQUALS_PARQUET"),
            F.col("issue_code").asc_nulls_first(),
            "final_action",
        )
    )


def unclassified_rate(clean: DataFrame) -> DataFrame:
    """Clean rows, unclassified errors among them, and their share of rows and of errors."""
    return clean.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.count_if(F.col("level") == "ERROR").alias("error_rows"),
        F.count_if(F.col("error_type") == UNCLASSIFIED).alias("unclassified_errors"),
    ).select(
        "*",
        (F.col("unclassified_errors") / F.nullif("clean_rows", F.lit(0))).alias("share_of_rows"),
        (F.col("unclassified_errors") / F.nullif("error_rows", F.lit(0))).alias("share_of_errors"),
    )


def report_facts(ledger: DataFrame, clean: DataFrame) -> DataFrame:
    """The headline facts of a report as ``(section, metric, value)`` text rows."""
    rollup = error_rollup(clean)

    def fact(section: str, metric: Column, value: Column) -> list[Column]:
        return [F.lit(section).alias("section"), metric.alias("metric"), value.cast("string").alias("value")]

    top_service = service_error_counts(rollup).filter(F.col("rank") == 1)
    unusual = daily_error_counts(rollup).filter("is_unusual_by_2x_median_rule")
    types = top_error_types(rollup)
    quality = quality_reconciliation(ledger, clean)
    day = F.col("event_date_utc").cast("string")
    blocks = [
        top_service.select(*fact("top_service", F.col("service"), F.col("error_count"))),
        unusual.select(
            *fact(
                "unusual_day",
                day,
                F.concat_ws(
                    " ",
                    F.col("daily_error_count").cast("string"),
                    F.format_string("%.3f", F.col("error_count_to_median_ratio")),
                    F.col("service_contributions"),
                ),
            )
        ),
        types.select(
            *fact(
                "top_error_type",
                F.col("error_type"),
                F.concat_ws(" ", F.col("error_count").cast("string"), F.col("service_contributions_json")),
            )
        ),
        types.filter(F.col("rank") == 1).select(
            *fact("unclassified", F.lit(UNCLASSIFIED), F.col("unclassified_error_count"))
        ),
        quality.select(
            *fact(
                "quality",
                F.concat_ws("/", "metric_type", "issue_code", "final_action"),
                F.concat_ws(" ", F.col("record_count").cast("string"), F.col("issue_occurrences").cast("string")),
            )
        ),
    ]
    result = blocks[0]
    for block in blocks[1:]:
        result = result.unionByName(block)
    return result


@dataclass(frozen=True)
class Analysis:
    """One registered analysis: its builder and the columns it must return."""

    analysis_id: str
    build: Callable[[DataFrame, DataFrame], DataFrame]
    columns: tuple[str, ...]


ANALYSES = {
    a.analysis_id: a
    for a in (
        Analysis(
            "service-error-counts",
            lambda ledger, clean: service_error_counts(clean),
            ("rank", "service", "error_count"),
        ),
        Analysis(
            "daily-error-counts",
            lambda ledger, clean: daily_error_counts(clean),
            (
                "event_date_utc",
                "daily_error_count",
                "median_error_count",
                "error_count_to_median_ratio",
                "is_unusual_by_2x_median_rule",
                "service_contributions",
            ),
        ),
        Analysis(
            "top-normalized-errors",
            lambda ledger, clean: top_error_types(clean),
            ("rank", "error_type", "error_count", "service_contributions_json", "unclassified_error_count"),
        ),
        Analysis(
            "quality-reconciliation",
            quality_reconciliation,
            (
                "metric_type",
                "issue_code",
                "final_action",
                "record_count",
                "issue_occurrences",
                "is_reconciled",
            ),
        ),
    )
}


def run_analysis(analysis_id: str, ledger: DataFrame, clean: DataFrame) -> DataFrame:
    """A registered analysis by id; an unknown id or unexpected columns are errors."""
    try:
        analysis = ANALYSES[analysis_id]
    except KeyError as error:
        raise ValueError(f"unknown analysis id: {analysis_id}") from error
    return require_columns(analysis.build(ledger, clean), analysis.columns, analysis_id)
