"""Writers of the published tables, and the reader of JSON lines; Spark's committers make writes all-or-nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def write_clean(
    clean: DataFrame, path: str, mode: str = "error", observation: Observation | None = None, **options: str
) -> None:
    """Zstd Parquet by UTC day; ``observation`` gets ``clean``, the rows written.

    Rows are dealt by day, where a heavy day is split over tasks and light ones share one, so there
    are neither huge nor very many files.
    """
    dealt = clean.hint("rebalance", "event_date_utc").sortWithinPartitions("event_date_utc", "source_line")
    # Counted in the stage that writes, where a repeated task counts once.
    counted = dealt.observe(observation, F.count(F.lit(1)).alias("clean")) if observation else dealt
    (
        counted.write.mode(mode)
        .options(compression="zstd", **options)
        .partitionBy("event_date_utc")
        .parquet(path)
    )


def write_ledger(ledger: DataFrame, path: str, mode: str = "error") -> None:
    """The ledger as zstd Parquet with its nested columns."""
    ledger.write.mode(mode).option("compression", "zstd").parquet(path)


def write_json_lines(frame: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines with every field present, columns in name order."""
    ordered = frame.select(*sorted(frame.columns))
    ordered.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema; a line that does not fit it is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).select(*schema.names)


def write_table_csv(result: DataFrame, path: str, mode: str = "error") -> None:
    """A small ordered result as CSV with a header; quotes inside a field are doubled, null is an empty field."""
    text = result.select(*[F.col(c).cast("string").alias(c) for c in result.columns])
    text.write.mode(mode).options(header="true", escape='"').csv(path)


def read_table_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Such a file as text columns; a header other than ``columns`` is an error."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {"header": "true", "escape": '"', "enforceSchema": "false", "mode": "FAILFAST", "multiLine": "true"}
    return spark.read.schema(schema).options(**options).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in any store Spark reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path``, in any store Spark writes."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
