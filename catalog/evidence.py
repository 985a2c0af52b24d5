"""Evidence (E), corpus audit (C) and incremental runs (I)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import extraction as extraction_queries
from catalog import knowledge, logs
from proofline.functions.fingerprints import content_fingerprint
from proofline.functions.logic import logic_digest
from proofline.operators import analyses, audit, documents, evaluation, evidence, extraction, ledger
from proofline.operators.duplicates import is_analytical, resolve_duplicates
from proofline.operators.history import DigestHistory
from proofline.plans import log_quality
from proofline.schemas import CLEAN_SCHEMA, LEDGER_SCHEMA
from proofline.session import ensure_settings, shared_folder
from proofline.sources import views
from proofline.streaming import daily

# Documents per file of the inventory, and lines per file of a daily delivery.
FILE_DOCUMENTS = 1000
DAILY_FILE_LINES = 5000


def _published(spark, folder) -> log_quality.Published:
    return log_quality.publish(logs.line_set(spark, folder), shared_folder(spark, "published"))


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _flat_ledger(book: DataFrame) -> DataFrame:
    """All columns of the ledger, nested ones as text."""
    return book.withColumns({"issues": logs.issue_text(), "normalizations": logs.normalization_text()})


def _flat_clean(clean: DataFrame) -> DataFrame:
    """All columns of the clean rows, instants and days as text."""
    return clean.withColumns(
        {"timestamp_utc": logs.instant_text("timestamp_utc"), "event_date_utc": F.col("event_date_utc").cast("string")}
    )


def _results(book: DataFrame, clean: DataFrame) -> dict[str, DataFrame]:
    return {i: logs.shown(analyses.run_analysis(i, book, clean)) for i in analyses.ANALYSES}


def _artifacts(published: log_quality.Published) -> dict[str, DataFrame]:
    return {
        "ledger": _flat_ledger(published.ledger),
        "clean": _flat_clean(published.clean),
        **_results(published.ledger, published.clean),
    }


def _stored_results(published: log_quality.Published) -> dict[str, DataFrame]:
    """The analyses' results written as a run publishes them, and read back."""
    spark = published.clean.sparkSession
    root = shared_folder(spark, "results")
    stored = {}
    for name, frame in _results(published.ledger, published.clean).items():
        frame.write.parquet(f"{root}/{name}")
        stored[name] = spark.read.schema(frame.schema).parquet(f"{root}/{name}")
    return stored


def _logic(spark) -> dict[str, str]:
    """Digest of every registered analysis over empty tables of the published columns."""
    book, clean = spark.createDataFrame([], LEDGER_SCHEMA), spark.createDataFrame([], CLEAN_SCHEMA)
    return {i: logic_digest(analyses.run_analysis(i, book, clean)) for i in analyses.ANALYSES}


def _text_hashes(spark, folder) -> DataFrame:
    """Documents as files of an inventory, with their label where there is one."""
    ensure_settings(spark)
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".md")))
    return (
        views.table(spark, folder, "documents")
        .join(views.table(spark, folder, "labels"), "doc_id", "left")
        .select("doc_id", "lang", "source", "text", "quality", "toxic", path.alias("path"))
    )


# ---------------------------------------------------------------- E


def source_inventory(spark, folder):
    """Documents written to files of ``FILE_DOCUMENTS`` ids each, and the inventory of those."""
    ensure_settings(spark)
    path = shared_folder(spark, "document-files")
    rows = views.table(spark, folder, "documents").withColumn("block", F.floor(F.col("doc_id") / FILE_DOCUMENTS))
    rows.repartition("block").sortWithinPartitions("block", "doc_id").select("block", "text").write.partitionBy("block").text(path)
    found = evidence.source_inventory(spark, path).filter(F.col("path").endswith(".txt"))
    block = F.regexp_extract("path", "block=([0-9]+)/", 1).cast("long")
    return found.select(block.alias("block"), "byte_size", "sha256")


def inventory_diff(spark, folder):
    """After a review: toxic documents gone, poor ones redacted, benchmark items added."""
    now = _text_hashes(spark, folder)
    before = now.select("path", F.sha2("text", 256).alias("sha256"))
    redacted = F.when(F.col("quality") == 0, F.concat(F.col("text"), F.lit(" [redacted]"))).otherwise(F.col("text"))
    after = now.filter(F.coalesce(F.col("toxic") != 1, F.lit(True))).select(
        "path", F.sha2(redacted, 256).alias("sha256")
    )
    added = views.table(spark, folder, "benchmark").select(
        F.concat(F.lit("benchmark/"), F.col("item_id").cast("string"), F.lit(".md")).alias("path"),
        F.sha2("text", 256).alias("sha256"),
    )
    return evidence.inventory_diff(before, after.unionByName(added))


def inventory_agreement(spark, folder):
    """What was declared, what was seen before a run, and what after it, in one comparison."""
    now = _text_hashes(spark, folder).withColumn("sha256", F.sha2("text", 256))
    before = now.filter(F.coalesce(F.col("toxic") != 1, F.lit(True))).select(
        "path", F.when(F.col("quality") == 0, F.sha2(F.upper("text"), 256)).otherwise(F.col("sha256")).alias("sha256")
    )
    after = now.filter(F.col("source") != "src0").select(
        "path", F.when(F.col("lang") == "fr", F.sha2(F.lower("text"), 256)).otherwise(F.col("sha256")).alias("sha256")
    )
    found = evidence.inventory_agreement({"declared": now, "before": before, "after": after})
    return found.select("path", *[F.array_join(c, ",").alias(c) for c in ("present", "missing", "odd")], "status")


def artifact_manifest(spark, folder):
    return evidence.artifact_manifest(_artifacts(_published(spark, folder)))


def analysis_links(spark, folder):
    """Every analysis result with its input table; of the digests of logic, that they are stable and see a changed rule."""
    manifest = evidence.artifact_manifest(_artifacts(_published(spark, folder)))
    logic = _logic(spark)
    links = evidence.analysis_links(manifest, logic, "clean")
    other = logic_digest(analyses.service_error_counts(spark.createDataFrame([], CLEAN_SCHEMA), "WARN"))
    again = spark.createDataFrame(sorted(_logic(spark).items()), "analysis_id string, again string")
    return links.join(again, "analysis_id").select(
        "analysis_id",
        (F.col("logic_sha256") == F.col("again")).alias("logic_is_stable"),
        (F.col("logic_sha256") != other).alias("logic_sees_rules"),
        "result_fingerprint",
        "result_row_count",
        "dataset_fingerprint",
    )


def run_fingerprint(spark, folder):
    return evidence.run_fingerprint(evidence.artifact_manifest(_artifacts(_published(spark, folder))))


def verify_manifest(spark, folder):
    """Published statements against a run someone changed: a service left out, actions forged, a result cut, a rule changed.

    Digests of logic are shown as the words ``published`` and ``changed``.
    """
    published = _published(spark, folder)
    results = _stored_results(published)
    logic = _logic(spark)
    said = evidence.state(
        {"ledger": _flat_ledger(published.ledger), "clean": _flat_clean(published.clean), **results}, logic, shared_folder(spark, "statement")
    )
    forged = F.when(
        F.exists("issues", lambda i: i["issue_code"] == "LEVEL_UNKNOWN"), F.lit("MAYBE")
    ).otherwise(F.col("final_action"))
    book = published.ledger.withColumn("final_action", forged)
    clean = published.clean.filter(F.col("service") != "batch-report")
    cut = {**results, "top-normalized-errors": results["top-normalized-errors"].filter("rank > 1")}
    other = logic_digest(analyses.service_error_counts(spark.createDataFrame([], CLEAN_SCHEMA), "WARN"))
    live = evidence.state(
        {"ledger": _flat_ledger(book), "clean": _flat_clean(clean), **cut},
        {**logic, "service-error-counts": other},
        shared_folder(spark, "statement"),
    )
    checks = evidence.verify_manifest(said, live)
    is_logic = F.col("check_name").startswith("logic ")
    shown = F.when(F.col("ok"), "published").otherwise("changed")
    return checks.select(
        "check_name",
        F.when(is_logic, "published").otherwise(F.col("expected")).alias("expected"),
        F.when(is_logic, shown).otherwise(F.col("actual")).alias("actual"),
        "ok",
    )


def reconstruction_diff(spark, folder):
    """Both tables rebuilt from the lines against published ones that someone changed.

    In the clean rows an error class is missing and another renamed, in the ledger raw lines are cut.
    """
    checked = logs.stage_checked(spark, folder)
    # The digest of the source is made once for both tables.
    files = _stored(logs.line_set(spark, folder).files, "files")
    published = _published(spark, folder)
    clean = _flat_clean(published.clean).filter(F.coalesce(F.col("error_type") != "NULL_POINTER", F.lit(True)))
    clean = clean.withColumn(
        "error_type", F.when(F.col("error_type") == "HTTP_502", F.lit("HTTP_500")).otherwise(F.col("error_type"))
    )
    cut = F.when(F.col("source_line") % 50 == 1, F.substring("raw_line", 1, 20)).otherwise(F.col("raw_line"))
    book = _flat_ledger(published.ledger).withColumn("raw_line", cut)
    rebuilt_clean = _stored(_flat_clean(ledger.clean_from_checked(checked, files)), "rebuilt-clean")
    rebuilt_book = _stored(_flat_ledger(ledger.ledger_from_resolved(resolve_duplicates(checked), files)), "rebuilt-ledger")
    columns = ("source_line", "status", "copies", "row_sha256")
    of = lambda name, new, old: evidence.reconstruction_diff(new, old, "source_line").select(
        F.lit(name).alias("table_name"), *columns
    )
    return of("clean", rebuilt_clean, clean).unionByName(of("ledger", rebuilt_book, book))


def input_binding(spark, folder):
    """Every document as a descriptor: some digests cut, some paths pointing outside."""
    rows = _text_hashes(spark, folder).withColumn("sha256", F.sha2("text", 256))
    descriptors = rows.select(
        "doc_id",
        F.when(F.col("quality") == 0, F.concat(F.lit("../"), "path")).otherwise(F.col("path")).alias("path"),
        F.when(F.col("toxic") == 1, F.substring("sha256", 1, 10)).otherwise(F.col("sha256")).alias("sha256"),
    )
    live = rows.filter(F.col("source") != "src0").select(
        "path", F.when(F.col("lang") == "fr", F.sha2(F.lower("text"), 256)).otherwise(F.col("sha256")).alias("sha256")
    )
    return evidence.input_binding(descriptors, rows, live).select("doc_id", "path", "status")


def run_summary(spark, folder):
    published = _published(spark, folder)
    said = evidence.state(_artifacts(published), _logic(spark), shared_folder(spark, "statement"))
    names = ("input", "accept", "repair", "reject", "invalid_action", "clean")
    log_totals = said.totals.agg(
        *[F.sum(F.when(F.col("name") == n, F.col("total")).otherwise(0)).alias(n) for n in names]
    )
    # The index first, so that the evaluation reads it instead of cutting the texts once more.
    indexed = knowledge.index(spark, folder)
    scored = evaluation.score_retrieval(knowledge.evaluated(spark, folder, contents=False))
    grades = scored.agg(
        *[F.count_if(F.col("retrieval_hit_score") == g).alias(g) for g in evaluation.GRADES]
    )
    results = extraction.case_results(extraction_queries.compared(spark, folder), "case_no")
    answers = results.agg(
        F.count(F.lit(1)).alias("responses"), F.count_if("passed").alias("passed")
    )
    responses = content_fingerprint(views.extraction_responses(spark, folder).select("case_no", "response_json"))
    stats = documents.build_stats(knowledge.inventory(spark, folder), indexed.chunks)
    run = evidence.run_fingerprint(said.manifest)
    return evidence.run_summary(
        {
            "manifest": run,
            "logs": log_totals,
            "knowledge_base": stats,
            "evaluation": grades,
            "extraction": answers,
            "responses": responses,
        }
    )


# ---------------------------------------------------------------- C


def secret_scan(spark, folder):
    ensure_settings(spark)
    return audit.secret_scan(views.table(spark, folder, "documents"), "doc_id")


def _limits(spark):
    return spark.createDataFrame([("en", 1), ("fr", 2), ("de", 1)], "lang string, max_pages int")


def length_limits(spark, folder):
    ensure_settings(spark)
    found = audit.length_limits(views.table(spark, folder, "documents"), _limits(spark), "doc_id", "lang")
    return found.select("doc_id", "lang", "words", "max_words", "status")


def required_presence(spark, folder):
    ensure_settings(spark)
    return audit.required_presence(
        views.table(spark, folder, "documents"), views.table(spark, folder, "labels"), "doc_id"
    )


def _items(spark, folder) -> DataFrame:
    """Documents as files: some languages in folders or formats a scan leaves out."""
    ensure_settings(spark)
    ending = F.when(F.col("lang") == "de", F.lit(".lock")).otherwise(F.lit(".md"))
    path = F.concat(
        F.when(F.col("source") == "src3", F.lit("node_modules/")).otherwise(F.lit("")),
        F.col("source"),
        F.lit("/"),
        F.col("doc_id").cast("string"),
        ending,
    )
    return views.table(spark, folder, "documents").withColumn("path", path)


def scan_exclusions(spark, folder):
    return audit.scan_exclusions(_items(spark, folder)).select("doc_id", "path")


def audit_summary(spark, folder):
    texts = _items(spark, folder)
    scanned = audit.scan_exclusions(texts)
    found = audit.secret_scan(scanned, "doc_id").select("doc_id")
    fine = scanned.select("doc_id").join(found, "doc_id", "left_anti").select(F.lit("pass").alias("status"))
    leaks = found.select(F.lit("fail").alias("status")).unionByName(fine)
    lengths = audit.length_limits(texts, _limits(spark), "doc_id", "lang")
    missing = audit.required_presence(texts, views.table(spark, folder, "labels"), "doc_id").select("doc_id")
    there = texts.select("doc_id").join(missing, "doc_id", "left_anti").select(F.lit("pass").alias("status"))
    present = missing.select(F.lit("warn").alias("status")).unionByName(there)
    return audit.audit_summary(
        {"secrets": leaks, "lengths": lengths, "labels": present}
    )


# ---------------------------------------------------------------- I


def _daily(spark, folder) -> daily.DailyTables:
    tables = daily.DailyTables(shared_folder(spark, "daily"))
    daily.run_available(spark, logs.stage_log_files(spark, folder, DAILY_FILE_LINES), tables)
    return tables


def incremental_ingest(spark, folder):
    book = _daily(spark, folder).read(spark, "ledger")
    return book.select(
        F.regexp_extract("source_path", "block=([0-9]+)", 1).cast("long").alias("block"),
        "source_line",
        "final_action",
        "retained_source_line",
    )


def curated_partitions(spark, folder):
    """Curated rows of every day, asked for by the name of the registered table."""
    curated = spark.table(_daily(spark, folder).curated_table)
    return curated.groupBy(F.col("event_date_utc").cast("string").alias("event_date_utc")).agg(
        F.count(F.lit(1)).alias("clean_rows"), F.count_if(F.col("level") == "ERROR").alias("error_rows")
    )


def cross_batch_duplicates(spark, folder):
    """The log in two deliveries: records of the first are in the history when the second is resolved."""
    checked = logs.stage_checked(spark, folder)
    history = DigestHistory(shared_folder(spark, "history"))
    later = F.col("source_line") % 2 == 0
    first = _stored(resolve_duplicates(checked.filter(~later)), "first-delivery")
    kept = first.filter(is_analytical(F.col("final_action")))
    history.append(1, kept.select("record_digest", F.col("line_seq").alias("retained_seq")))
    arrived = checked.filter(later)
    known = history.matching(spark, 2, arrived.filter(is_analytical(F.col("first_action"))))
    columns = ("source_line", "final_action", "retained_source_line")
    return first.select(F.lit(1).alias("batch"), *columns).unionByName(
        resolve_duplicates(arrived, known).select(F.lit(2).alias("batch"), *columns)
    )


QUERIES = {
    "source_inventory": source_inventory,
    "inventory_diff": inventory_diff,
    "inventory_agreement": inventory_agreement,
    "artifact_manifest": artifact_manifest,
    "analysis_links": analysis_links,
    "run_fingerprint": run_fingerprint,
    "verify_manifest": verify_manifest,
    "reconstruction_diff": reconstruction_diff,
    "input_binding": input_binding,
    "run_summary": run_summary,
    "secret_scan": secret_scan,
    "length_limits": length_limits,
    "required_presence": required_presence,
    "scan_exclusions": scan_exclusions,
    "audit_summary": audit_summary,
    "incremental_ingest": incremental_ingest,
    "curated_partitions": curated_partitions,
    "cross_batch_duplicates": cross_batch_duplicates,
}
