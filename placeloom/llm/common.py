"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word of all operators here: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that go to Python at once.
BATCH = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one if Spark runs
    in this process alone, as in tests; on a cluster that is an error, since executors would not see the driver's folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    bounded_batches(spark)
    df.write.option("compression", "zstd").parquet(path)
    # what the plan shuffled is not needed any more: its files go when the driver's JVM collects its garbage
    spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(*staged: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def text_of(col: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH bytes at most, or of one row, whatever the length of the texts; a smaller bound that is set stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = spark.conf.get(name).lower().removesuffix("b")
    if not found.isdigit() or not 0 < int(found) <= BATCH:
        spark.conf.set(name, str(BATCH))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 200) -> Iterator[None]:
    """Rows with several texts go to Python by few at a time: bounds a task's memory. For what is staged inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
