"""Tables: scans, sinks, versioned writes, whole databases, exports."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows in one file at most, so that hot partitions give several files of a readable size.
FILE_ROWS = 5_000_000


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A path of Parquet files, or a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create the partitioned table unless it is there."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts}")


def _writer(df: DataFrame, partition_by: Sequence[str]):
    w = df.write.option("maxRecordsPerFile", FILE_ROWS)
    return w.partitionBy(*partition_by) if partition_by else w


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _writer(df, partition_by).mode("append").parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table, or, if it is partitioned, only the partitions that df has."""
    w = _writer(df, partition_by).mode("overwrite")
    (w.option("partitionOverwriteMode", "dynamic") if partition_by else w).parquet(path)


def append_partitioned(df: DataFrame, name: str, *partition_by: str) -> None:
    """Append to a managed catalog table."""
    df.write.mode("append").format("parquet").partitionBy(*partition_by).saveAsTable(name)


VERSIONS = "number long, path string, at timestamp, writer string, batch long"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The published versions of the table at root: number (from 1), path, at, and what the writer said
    of itself. Empty if there are none yet."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{root}/_versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def write_version(df: DataFrame, root: str, writer: str | None = None, batch: int | None = None) -> str:
    """Write df as a new version under root and make it the one that ``read_version`` gives.

    One row in a small append-only Parquet table publishes the version together with its writer and
    batch, so a reader sees the old version or the new one, and a batch is recorded if and only if its
    rows are visible. Versions are numbered, so clocks play no part; a table has one writer at a time.
    The files that df is computed from are never overwritten."""
    spark = df.sparkSession
    path = f"{root}/v-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    last = versions(spark, root).agg(F.max("number")).first()[0] or 0
    row = spark.range(1).select(F.lit(last + 1).cast("long").alias("number"), F.lit(path).alias("path"), F.current_timestamp().alias("at"), F.lit(writer).cast("string").alias("writer"), F.lit(batch).cast("long").alias("batch"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/_versions")
    return path


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The version with the highest number."""
    return spark.read.parquet(versions(spark, root).agg(F.max_by("path", F.struct("number", "path"))).first()[0])


PUBLISHED = "number long, paths map<string,string>, at timestamp, writer string, batch long"


def published(spark: SparkSession, root: str) -> DataFrame:
    """The published states of the tables at root: number (from 1), paths (table -> folder), at, and what the
    writer said of itself. Empty if there are none yet."""
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{root}/_published")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each table in the newest published state."""
    return published(spark, root).agg(F.max_by("paths", "number")).first()[0] or {}


def publish(tables: Mapping[str, DataFrame], root: str, writer: str | None = None, batch: int | None = None) -> dict[str, str]:
    """Write new versions of several tables, then make all of them visible by one row: readers see the tables
    before or after, never some of each. Tables that are not given keep their version. A failure between
    the writes leaves folders that no state names; one writer at a time."""
    spark = next(iter(tables.values())).sparkSession
    paths = current_paths(spark, root)
    for name, df in tables.items():
        paths[name] = f"{root}/{name}/v-{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(paths[name])
    last = published(spark, root).agg(F.max("number")).first()[0] or 0
    told = F.create_map(*(F.lit(x) for pair in sorted(paths.items()) for x in pair))
    row = spark.range(1).select(F.lit(last + 1).cast("long").alias("number"), told.alias("paths"), F.current_timestamp().alias("at"), F.lit(writer).cast("string").alias("writer"), F.lit(batch).cast("long").alias("batch"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return paths


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(current_paths(spark, root)[name])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever the session's file systems have it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the folders of all but the newest ``keep`` versions (of one table or of several) at root; their
    rows in the log stay. Call it when no reader can still hold an older one. The number of folders deleted."""
    logs = versions(spark, root).select("number", "path").unionByName(published(spark, root).select("number", F.explode("paths").alias("_", "path")).drop("_"))
    newest = logs.agg(F.max("number")).first()[0] or 0
    used = logs.groupBy("path").agg(F.max("number").alias("last")).filter(F.col("last") <= newest - keep)
    old = [r["path"] for r in used.collect()]  # a row a version
    for path in old:
        remove(spark, path)
    return len(old)


BUCKET = "key_bucket"


def merge_buckets(path: str, updates: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame | None, DataFrame], DataFrame], buckets: int = 64) -> list[int]:
    """Merge updates into the table at path, reading and writing only what they can touch: rows lie in folders by
    a hash of their key, the buckets of the updates are found first, only these are read, merged and put in
    place of the old ones (dynamic partition overwrite), by way of a staged copy. Their numbers.

    merge(rows of these buckets or None, updates) must keep or add a row in every bucket, as merges by key
    do. A merge that gives the same when it is applied twice (``scd2_merge``, ``upsert``) can be repeated
    after a failure. The number of buckets belongs to the table and must not change."""
    spark = updates.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    staged_updates = written(updates, "updates")
    touched = sorted(r[0] for r in staged_updates.select(bucket.alias("b")).distinct().collect())  # numbers, as many as buckets at most
    if not touched:
        return []
    try:
        there = spark.read.parquet(path)
        old = there.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    merged = written(merge(old, staged_updates).withColumn(BUCKET, bucket), "merged")
    found = {r[0] for r in merged.select(BUCKET).distinct().collect()}
    if found != set(touched):
        raise ValueError(f"the merge left buckets {sorted(set(touched) ^ found)} empty or touched others")
    merged.repartition(BUCKET).write.option("maxRecordsPerFile", FILE_ROWS).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched


def combine_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables in one relation tagged by origin; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("source_table", F.lit(n)) for n, df in sorted(tables.items())))


def load_database(spark: SparkSession, database: str) -> DataFrame:
    """Every table of a catalog database."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return combine_tables({n: spark.table(f"{database}.{n}") for n in names})


def export_csv(df: DataFrame, path: str, max_bytes: int) -> bool:
    """Write CSV files with a header unless the rows' text, summed up first, is larger than the guard."""
    size = df.agg(F.sum(F.octet_length(F.to_csv(F.struct("*"))) + 1)).first()[0] or 0
    if size > max_bytes:
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def upsert_vectors(table: DataFrame, updates: DataFrame, key: str, version: str) -> DataFrame:
    """Vectors with payload, keyed: of a key's rows in both tables the one with the highest version stays."""
    both = table.unionByName(updates)
    return both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), version).alias("_r")).select(key, "_r.*")


#: Folders that ``scratch`` named in this process.
_SCRATCH: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete all folders that ``scratch`` and ``written`` made in this process: call it when the results that
    read them have been used. How many they were."""
    many = len(_SCRATCH)
    while _SCRATCH:
        remove(spark, _SCRATCH.pop())
    return many


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: what several branches of a plan read is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared folder. Where the session has none, a temporary one in
    local mode (tests); on a cluster, where other machines could not read that, an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path
