"""A table kept in the order of its key: ranges of it as Parquet files, and a small index that says which keys each range holds.

root/data/<snapshot>/range=<n> are the ranges that a snapshot wrote; root/index/snapshot=<n> has a row a range of the whole
table: path, low, high (structs of the key), rows. A reader takes the newest index and opens the ranges it needs and no others; a writer replaces
the ranges that its keys fall in and writes a new index last, so that readers see one snapshot or the other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a range: about 64 MB of catalogue rows. A task that writes ranges takes as many rows at least, however small they are.
RANGE_ROWS = 500_000
#: Index rows that a reader looks at at a time.
LOOK = 64


def _write_ranges(rows: DataFrame, root: str, snapshot: int, key: list[str], range_rows: int, begins: list[tuple] = ()) -> DataFrame:
    """Writes rows as ranges of a snapshot, none of which holds keys on both sides of one of begins; their index rows."""
    spark, path = rows.sparkSession, f"{root}/data/{snapshot}"
    held = rows.persist(StorageLevel.DISK_ONLY)  # made once to be counted, sampled and written
    tasks = max(1, -(-held.count() // max(range_rows, RANGE_ROWS)))
    zone = sum((F.when(F.struct(*key) >= F.struct(*[F.lit(v).alias(k) for k, v in zip(key, b)]), 1).otherwise(0) for b in begins), F.lit(0))
    ordered = held.repartitionByRange(tasks, *key).sortWithinPartitions(*key).withColumn("_at", F.monotonically_increasing_id())  # the task, and in the low 33 bits the row's place in it
    place = F.concat_ws("-", F.shiftright("_at", 33), F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / range_rows), zone)
    dealt = ordered.withColumn("range", place).drop("_at")
    dealt.sortWithinPartitions("range", *key).write.mode("overwrite").partitionBy("range").parquet(path)
    held.unpersist()
    written = spark.read.schema(dealt.schema).parquet(path)
    place = F.struct(*key)
    return written.groupBy("range").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("rows")).select(F.concat(F.lit(f"{snapshot}/range="), "range").alias("path"), "low", "high", "rows")


def build(rows: DataFrame, root: str, key: list[str], range_rows: int = RANGE_ROWS) -> None:
    """The first snapshot: rows, one a key, in ranges of about range_rows rows. A null in the key comes first."""
    rows.limit(0).write.mode("overwrite").parquet(f"{root}/schema")
    _write_ranges(rows, root, 0, key, range_rows).write.mode("overwrite").parquet(f"{root}/index/snapshot=0")


def current(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number and index of the newest snapshot."""
    index = spark.read.parquet(f"{root}/index")
    newest = int(index.agg(F.max(F.col("snapshot").cast("int"))).first()[0] or 0)
    return newest, spark.read.parquet(f"{root}/index/snapshot={newest}")


def read_ranges(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The rows of some ranges."""
    schema = spark.read.parquet(f"{root}/schema").schema
    return spark.read.schema(schema).parquet(*[f"{root}/data/{p}" for p in paths]) if paths else spark.createDataFrame([], schema)


def read_from(spark: SparkSession, root: str, key: str, prefix: str, after: str, rows: int) -> DataFrame:
    """The ranges that hold the next `rows` rows under a prefix after a key, by the index; a table of a one-column key. Other ranges are not opened, however many there are."""
    _, index = current(spark, root)
    low, high = F.col(f"low.{key}"), F.col(f"high.{key}")
    ahead = index.filter((high > after) & (high >= prefix) & (F.substring(low, 1, len(prefix)) <= prefix)).select("path", low.alias("low"), "rows")
    taken, sure, edge = [], 0, None
    while sure < rows:  # of the first range an unknown part is past the key, of the others all rows
        found = (ahead if edge is None else ahead.filter(F.col("low") > edge)).orderBy("low").limit(LOOK).collect()
        for r in found:
            if sure < rows:
                sure += r["rows"] if taken else 0
                taken.append(r["path"])
        if len(found) < LOOK:
            break
        edge = found[-1]["low"]
    return read_ranges(spark, root, taken)


def merge(spark: SparkSession, root: str, key: list[str], page: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], range_rows: int = RANGE_ROWS) -> dict:
    """A new snapshot in which the ranges that page's keys fall in are what change(their rows, page) gives; the others are as they were, unread.

    Keys are taken by their first column: of each of its values, the ranges between the least and the greatest key of the page. A page as a listing walks them lies
    side by side, so it touches as few ranges as it is long. Returns snapshot, touched and kept (numbers of ranges) and rows (of the changed ranges).
    """
    snapshot, index = current(spark, root)
    place, page = F.struct(*key), page.persist(StorageLevel.DISK_ONLY)
    spans = page.groupBy(key[0]).agg(F.min(place).alias("_from"), F.max(place).alias("_to"))  # a row a venue
    hit = index.join(F.broadcast(spans), (F.col("high") >= F.col("_from")) & (F.col("low") <= F.col("_to")), "left_semi")
    found = hit.collect()  # what is read and written anyway
    touched, at = [r.path for r in found], lambda s: tuple((x is not None, x) for x in s)  # nulls first
    reach = sorted([(tuple(r.low), tuple(r.high)) for r in found] + [(tuple(r["_from"]), tuple(r["_to"])) for r in spans.collect()], key=lambda x: (at(x[0]), at(x[1])))
    begins, end = [], None  # of the stretches of keys that are written anew: untouched ranges lie between them
    for low, high in reach:
        if end is None or at(low) > at(end):
            begins.append(low)
        end = high if end is None or at(high) > at(end) else end
    old = read_ranges(spark, root, touched)
    new = _write_ranges(change(old, page).select(*old.columns), root, snapshot + 1, key, range_rows, begins)
    left = index.join(F.broadcast(spark.createDataFrame([(p,) for p in touched], "path string")), "path", "left_anti")
    left.unionByName(new).write.mode("overwrite").parquet(f"{root}/index/snapshot={snapshot + 1}")
    page.unpersist()
    made = F.startswith("path", F.lit(f"{snapshot + 1}/"))
    facts = current(spark, root)[1].agg(F.sum(F.when(made, F.col("rows"))).alias("rows"), F.count_if(~made).alias("kept")).first()
    return {"snapshot": snapshot + 1, "touched": len(touched), "kept": facts["kept"], "rows": int(facts["rows"] or 0)}


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest snapshot, by a path a range, as readers take them."""
    return read_ranges(spark, root, [r.path for r in current(spark, root)[1].select("path").collect()])
