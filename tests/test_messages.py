import json
import re

from pyspark.sql import functions as F

from proofline.functions.messages import ErrorTaxonomy, classify, parameter, parameter_pairs, parameters_json
from proofline.functions.text import quote_json, strip, word_count

CASES = {
    "ERR SMTPConnRefused host=mail-gw": ("SMTP_CONN_REFUSED", {"host": "mail-gw"}),
    "ERR PaymentDeclined code=DECLINED component=issuer path=/p code=2": (
        "PAYMENT_DECLINED",
        {"code": "2", "component": "issuer", "path": "/p"},
    ),
    "ERR ConnTimeout": ("CONNECTION_TIMEOUT", {}),
    "ERR NullPointer_2 x=1": ("UNCLASSIFIED_ERROR", {}),
    "ERR  NullPointer, b=1 a=é": ("NULL_POINTER", {"a": "é", "b": "1"}),
    "HTTP 502 path=/payments/submit": ("HTTP_502", {"path": "/payments/submit"}),
    "ERR Unknown k=0 HTTP 502 k=1": ("HTTP_502", {"k": "1"}),
    "xHTTP 502": ("UNCLASSIFIED_ERROR", {}),
    "HTTP 5020": ("UNCLASSIFIED_ERROR", {}),
    "err ConnTimeout": ("UNCLASSIFIED_ERROR", {}),
    'ERR ConnTimeout q="a\\b" c=\x0e\x01': ("CONNECTION_TIMEOUT", {"q": '"a\\b"', "c": "\x0e\x01"}),
    "ERR ConnTimeout a=1\n": ("CONNECTION_TIMEOUT", {"a": "1"}),
    "ERR ConnTimeout a=1\nb=2": ("UNCLASSIFIED_ERROR", {}),
    "": ("UNCLASSIFIED_ERROR", {}),
}


def test_classes_and_parameters(spark):
    frame = spark.createDataFrame([(m,) for m in CASES], "m string")
    error_type, details = classify(F.col("m"), ErrorTaxonomy())
    rows = (
        frame.select("m", error_type.alias("t"), details.alias("d"))
        .withColumn("p", parameter_pairs(F.col("d")))
        .select("m", "t", parameters_json(F.col("p")).alias("j"), parameter(F.col("p"), "code").alias("code"))
        .collect()
    )
    for row in rows:
        wanted_type, wanted = CASES[row["m"]]
        assert row["t"] == wanted_type, row["m"]
        assert row["j"] == json.dumps(wanted, ensure_ascii=False, sort_keys=True, separators=(",", ":")), row["m"]
        assert row["code"] == wanted.get("code")


def test_taxonomy_can_be_extended(spark):
    taxonomy = ErrorTaxonomy(tokens={"DiskFull": "DISK_FULL"})
    frame = spark.createDataFrame([("ERR DiskFull",), ("ERR NullPointer",)], "m string")
    found = [r[0] for r in frame.select(classify(F.col("m"), taxonomy)[0]).collect()]
    assert found == ["DISK_FULL", "UNCLASSIFIED_ERROR"]


def test_text_functions_match_python(spark):
    texts = ["", " a b c\x1c\x85", "　x y​ ", 'q"\\\x00\x1f\x7f/ ', "[]", "a\tb\nc"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", quote_json(F.col("t")).alias("q"), strip(F.col("t")).alias("s"), word_count(F.col("t")).alias("n")
    )
    for row in rows.collect():
        assert row["q"] == json.dumps(row["t"], ensure_ascii=False)
        assert row["s"] == row["t"].strip()
        assert row["n"] == len(row["t"].split()) == len(re.findall(r"\S+", row["t"]))
