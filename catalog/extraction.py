"""Extraction scoring (X) over the ``extraction_responses`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofline.operators import extraction
from proofline.session import ensure_settings
from proofline.sources import views

KEY = "case_no"
SAMPLE_RATE = 0.1


def responses(spark, folder):
    ensure_settings(spark)
    return views.extraction_responses(spark, folder)


def parsed(spark, folder):
    return extraction.parse_outputs(responses(spark, folder))


def compared(spark, folder):
    return extraction.compare_outputs(responses(spark, folder))


def response_text(spark, folder):
    return extraction.response_text(responses(spark, folder)).select(KEY, "response_text")


def strip_code_fence(spark, folder):
    return extraction.response_text(responses(spark, folder)).select(
        KEY, extraction.strip_code_fence(F.col("response_text")).alias("output_text")
    )


def validate_extraction(spark, folder):
    return extraction.validate_extraction(parsed(spark, folder)).select(
        KEY, (F.size("errors") == 0).alias("is_valid"), F.array_join("errors", "; ").alias("errors")
    )


def compare_fields(spark, folder):
    return extraction.compare_fields(compared(spark, folder), KEY)


def trial_summary(spark, folder):
    return extraction.trial_summary(compared(spark, folder), KEY).withColumn("pass_rate", F.round("pass_rate", 6))


def case_results(spark, folder):
    return extraction.case_results(compared(spark, folder), KEY)


def field_accuracy(spark, folder):
    result = extraction.field_accuracy(parsed(spark, folder))
    return result.withColumns({n: F.round(n, 6) for n in ("schema_valid_rate", "recall", "precision")})


def hallucination_check(spark, folder):
    return extraction.hallucination_check(parsed(spark, folder), KEY)


def stratified_sample(spark, folder):
    frame = responses(spark, folder).select(KEY, "message")
    sample = extraction.stratified_sample(
        frame, KEY, extraction.message_pattern(F.col("message")), SAMPLE_RATE
    )
    return sample.select(KEY, "message", "stratum")


def review_routing(spark, folder):
    return extraction.review_routing(parsed(spark, folder), KEY)


def usage_rollup(spark, folder):
    result = extraction.usage_rollup(
        responses(spark, folder), extraction.message_pattern(F.col("message"))
    )
    return result.withColumn("latency_avg_ms", F.round("latency_avg_ms", 6))


def build_prompts(spark, folder):
    return extraction.build_prompts(responses(spark, folder).select(KEY, "message"))


QUERIES = {
    "response_text": response_text,
    "strip_code_fence": strip_code_fence,
    "validate_extraction": validate_extraction,
    "compare_fields": compare_fields,
    "case_results": case_results,
    "trial_summary": trial_summary,
    "field_accuracy": field_accuracy,
    "hallucination_check": hallucination_check,
    "stratified_sample": stratified_sample,
    "review_routing": review_routing,
    "usage_rollup": usage_rollup,
    "build_prompts": build_prompts,
}
