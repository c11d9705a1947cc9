"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch. Texts are whole, so a batch of the default 10,000 rows could be large.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches for the session, so that long texts don't meet in one batch. Spark reads the
    setting when a plan runs, not when it is declared, so it stays; smaller settings are kept."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = _bytes(spark.conf.get(name))
        if not 0 < now <= most:
            spark.conf.set(name, most)


def _bytes(value: str) -> int:
    found = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", value.strip().lower())
    return int(found[1]) << 10 * " kmgtp".index(found[2] or " ") if found else 0


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where the session names none, a temporary one in local mode
    (tests); on a cluster, where other machines could not read that, an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Folders that ``materialise`` wrote in this process.
_WRITTEN: list[str] = []


def clear_written(spark: SparkSession) -> int:
    """Delete all tables that ``materialise`` wrote in this process: call it when the results that read them have
    been used. How many they were."""
    many, conf = len(_WRITTEN), spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        at.getFileSystem(conf).delete(at, True)
    return many


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: later jobs neither repeat the
    work nor depend on the executors that did it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df does not have, one for each of names."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo parts; null ids are in no held-out part (-1)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(-1))
