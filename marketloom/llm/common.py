"""Shared pieces: scratch tables in the cluster's shared folder, components, byte views."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch sent to Python: long texts must not meet in one batch.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def small_batches(spark: SparkSession) -> None:
    for key, value in ARROW.items():
        spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; set here only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors would not see a folder of the driver's machine")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: a cut in the lineage that
    survives lost executors, and the same rows for every later reader."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files behind a stored() table that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def join_spread(rows: DataFrame, facts: DataFrame, keys: list[str], n: str = "n", parts: int = 2000) -> DataFrame:
    """rows joined to facts (one row a key, with n, how many of rows it has), without the key of many rows in one task.

    Keys with more than one in `parts` of the rows are at most `parts` keys, whatever the input, so their
    facts are broadcast; all other keys are joined as usual. Both are stored tables.
    """
    edge = max(rows.count() // parts, 1)
    hot = facts.filter(F.col(n) > edge)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(facts.filter(F.col(n) <= edge), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column of df has, in any case of letters: name, or name with underscores behind it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: str = "text"):
    """The UTF-8 bytes of a text; a null is an empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def out_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2048) -> Iterator[pa.RecordBatch]:
    """Tuples to record batches of a bounded number of rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component), the component
    being the smallest node in it. Alternates large-star and small-star steps, each a join and
    a minimum, over tables in the shared folder; ends when a round changes nothing. Nodes
    without an edge to another node are not returned. An empty input gives no rows."""
    def mark(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
        new = stored(small.filter("a <> b").distinct())
        marked = mark(new)
        drop_stored(now)
        now = new
        if marked == seen:
            break
        seen = marked
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
