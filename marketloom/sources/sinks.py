"""Writers: the partitioned vault, side files, logs and encoded messages."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.schema import levels_of, order_of, struct_of
from marketloom.session import scratch

NO_LEVEL = "ticks"
#: Input bytes above which a month has files by instrument.
SPLIT_BYTES = 1 << 30
#: Rows that a task puts in order at a time where a partition is one file, whatever its size.
SORT_ROWS = 500_000
#: Partitions of more rows that are put together at a time, a task each.
AT_ONCE = 16


def write_table(df: DataFrame, root: str, table: str, part: str = "own", weights: DataFrame | None = None, split_bytes: int = SPLIT_BYTES, records_per_file: int = 50_000_000) -> None:
    """Replaces the partitions that df has rows of; others stay. Rows are by symbol and time in each file.

    df has the table's columns and path levels; an absent level is written as `ticks`. weights (the
    path levels and bytes of each partition) says which months are light: those are one file each (see write_whole). All
    others are dealt by symbol and then rebalanced: Spark puts small symbols together and cuts large ones, so that a file is about
    spark.sql.adaptive.advisoryPartitionSizeInBytes of shuffled rows, whatever share of a month a symbol has.
    """
    levels = levels_of(table)
    rows = df.withColumns({c: F.coalesce(F.col(c), F.lit(NO_LEVEL)) if c in df.columns else F.lit(NO_LEVEL) for c in levels}).withColumn("part", F.lit(part))
    if weights is None:
        dealt = rows.hint("rebalance", *[F.col(c) for c in (*levels, "symbol")])
    else:
        # a row a partition
        laid = layout_for(weights, split_bytes).select(*levels, (F.col("layout") == "whole").alias("_whole"))
        marked = rows.join(F.broadcast(laid), levels, "left").withColumn("_whole", F.coalesce("_whole", F.lit(False)))
        light, heavy = marked.filter("_whole").drop("_whole"), marked.filter("NOT _whole").drop("_whole")
        write_whole(light, f"{root}/{table}", [*levels, "part"], order_of(table), scratch(df.sparkSession, "staged"), records_per_file=records_per_file)
        dealt = heavy.hint("rebalance", *[F.col(c) for c in (*levels, "symbol")])
    (dealt.sortWithinPartitions(*levels, *order_of(table)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .option("maxRecordsPerFile", records_per_file).partitionBy(*levels, "part").parquet(f"{root}/{table}"))


def write_whole(df: DataFrame, path: str, columns: list[str], order: list[str], staged: str, distinct: bool = False, records_per_file: int = 50_000_000) -> None:
    """Replaces the partitions (by columns) that df has rows of by one file each, in the order of `order`, which no task sorts whole.

    Rows are dealt by ranges of their partition and order, about SORT_ROWS a task, and staged in that order. Partitions of up to SORT_ROWS rows are then dealt whole and
    sorted again; each larger one is what its staged files give one after another, in a task of its own that sorts nothing.
    """
    spark, rest = df.sparkSession, [c for c in df.columns if c not in (*columns, *order)]
    held = df.persist(StorageLevel.DISK_ONLY)  # made once to be counted, sampled and staged
    if tasks := -(-held.count() // SORT_ROWS):
        ranged = held.repartitionByRange(tasks, *columns, *order, *rest)  # by all columns: equal rows meet, and rows of one time may be cut
        (ranged.distinct() if distinct else ranged).sortWithinPartitions(*columns, *order).write.mode("overwrite").partitionBy(*columns).parquet(staged)
    held.unpersist()
    if not tasks:
        return
    back = spark.read.schema(df.schema).parquet(staged)
    files = back.groupBy(*columns, F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_rows"))
    number = F.regexp_extract("_file", r"/part-(\d+)-[^/]*$", 1).cast("long").alias("_range")
    sizes = files.groupBy(*columns).agg(F.sum("_rows").alias("_rows"), F.array_sort(F.collect_list(F.struct(number, "_file")))["_file"].alias("_files")).persist(StorageLevel.DISK_ONLY)
    small = sizes.filter(F.col("_rows") <= SORT_ROWS)
    if rows := small.agg(F.sum("_rows")).first()[0]:
        match = reduce(lambda a, b: a & b, [back[c].eqNullSafe(small[c]) for c in columns])
        (back.join(F.broadcast(small.drop("_rows", "_files")), match, "left_semi").repartition(-(-rows // SORT_ROWS), *columns).sortWithinPartitions(*columns, *order)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", records_per_file).partitionBy(*columns).parquet(path))

    def joined(names: list[str]) -> None:
        names = [unquote(n) for n in names]  # by the number of their range: that is the order of the rows
        folder = "/".join(names[0].split("/")[-len(columns) - 1 : -1])
        pieces = [back_of(n) for n in names]
        reduce(DataFrame.union, pieces).coalesce(1).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", records_per_file).parquet(f"{path}/{folder}")

    back_of = spark.read.schema(back.drop(*columns).schema).parquet
    large = [r["_files"] for r in sizes.filter(F.col("_rows") > SORT_ROWS).select("_files").collect()]  # at most a partition for each SORT_ROWS rows
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(joined, large))
    sizes.unpersist()


def write_empty(spark, root: str, table: str, **levels: str) -> None:
    """A partition without rows still has a file with the table's columns."""
    path = "/".join([f"{root}/{table}", *[f"{c}={levels.get(c, NO_LEVEL)}" for c in levels_of(table)], "part=own"])
    spark.createDataFrame([], struct_of(table)).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(path)


def layout_for(partitions: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """partitions (with bytes) and how each is laid out: a file for each instrument, or one for all."""
    return partitions.withColumn("layout", F.when(F.col("bytes") >= split_bytes, "instrument").otherwise("whole"))


def compact_partitions(df: DataFrame, root: str, table: str, staged: str, distinct: bool = False) -> None:
    """Partitions of a table (df: their rows, read from root) that are in several pieces rewritten as one ordered file each (see write_whole).
    Partitions of one piece are neither read nor written.

    The pieces are staged in a folder beside the table first, as what is read cannot be replaced at once;
    a run that ends between the two has lost nothing.
    """
    columns = [*levels_of(table), "part"]
    names = df.select(*columns, F.col("_metadata.file_path").alias("_file")).distinct()
    several = names.groupBy(*columns).agg(F.count("*").alias("_pieces")).filter("_pieces > 1").drop("_pieces")
    # a row a partition: met without dealing the rows by partition, whose repeats would then be one task's
    df = df.join(F.broadcast(several), columns, "left_semi").select(*df.columns)  # Spark prunes the partitions that are not among these
    write_whole(df, f"{root}/{table}", columns, order_of(table), staged, distinct)


def write_sides(df: DataFrame, root: str, table: str, side: str) -> None:
    """Rows of a month that came with its neighbour: before (`pre`) or after (`post`) the month's own."""
    if side not in ("pre", "post"):
        raise ValueError(side)
    write_table(df, root, table, part=side)


#: The columns of a ledger's lines, in their order: every file of a log has all of them, as they are read by place.
LEDGER = ["partition", "state", "revision", "venue", "market", "dataset", "variant", "month", "grain", "bundle", "version", "pre_version", "post_version", "size", "count", "rows", "first", "last", "at"]


def append_ledger(df: DataFrame, path: str, at: int | None = None) -> None:
    """Lines (columns of LEDGER, those that are not there are empty) at the end of a log, stamped with when (ns): rows of one call are of one time, as they are of different partitions, and may lie in
    any number of files."""
    if more := set(df.columns) - set(LEDGER):
        raise ValueError(f"a ledger has no {sorted(more)}")
    lines = df.withColumns({c: F.lit(None).cast("string") for c in LEDGER if c not in df.columns}).withColumn("at", F.lit(at if at is not None else time.time_ns()))
    lines.select(*LEDGER).hint("rebalance").write.mode("append").options(sep="|", header=True).csv(path)


def recorded(partitions: DataFrame, path: str, write: Callable[[], dict | None]) -> None:
    """Runs write between two lines for each of partitions (partition, revision, ...): `updating` before, `stocked` after, so
    that a write that never ended is known by its line. What write gives (rows, first, last: what its pass has seen, or None) stands in the second line; a
    write that raises leaves the first one the last."""
    facts = dict.fromkeys(("rows", "first", "last"))
    note = lambda state, f: partitions.withColumns({"state": F.lit(state), **{k: F.lit(f.get(k)).cast("long") for k in facts}})
    append_ledger(note("updating", facts), path)
    append_ledger(note("stocked", write() or facts), path)


def encode_messages(messages: DataFrame, columns: list[str], order: str = "seq") -> DataFrame:
    """Messages (date, action, data: array of structs) to rows: the first of a message has its _date_ and
    _action_, later ones have them empty; a message without data keeps one row."""
    rows = messages.select(order, "date", "action", F.posexplode_outer("data").alias("row", "d"))
    first = F.coalesce(F.col("row"), F.lit(0)) == 0
    return rows.select(order, F.coalesce("row", F.lit(0)).alias("row"), F.when(first, F.col("date").cast("string")).otherwise("").alias("_date_"),
                       F.when(first, F.col("action")).otherwise("").alias("_action_"), *[F.coalesce(F.col("d")[c].cast("string"), F.lit("")).alias(c) for c in columns])


def write_withdrawals(events: DataFrame, path: str) -> None:
    """A JSON line for each file that left or came back."""
    events.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"', quote='"').csv(path)
