"""Reconciliation: what is stored, what should be, and what to do about the difference."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.names import parse_keys, revision


#: What a ledger line has for the version of a neighbour that was not there.
MISSING = "missing"


def _last_line(state: str) -> Column:
    return F.max(F.when(F.col("state") == state, F.col("line")))


def ledger_current(log: DataFrame, by: str = "partition", distrusted: DataFrame | None = None) -> DataFrame:
    """What an append-only log says of each partition now: its last stocked line, with outdated.

    `updating` takes away what was stocked before it, for good: only a later stocked line brings the partition back. `outdated` marks the
    stocked line before it, if one still holds. distrusted (by, revision): lines that the store was found not to bear out, left out.
    """
    others = [c for c in log.columns if c != by]
    stocked = F.when(F.col("state") == "stocked", F.col("line"))
    last = log.groupBy(by).agg(F.max_by(F.struct(*others), stocked).alias("_row"), F.max(stocked).alias("_at"), _last_line("updating").alias("_gone"), _last_line("outdated").alias("_old"))
    held = last.filter("_at IS NOT NULL AND (_gone IS NULL OR _at > _gone)").select(by, *[F.col("_row")[c].alias(c) for c in others], F.coalesce(F.col("_old") > F.col("_at"), F.lit(False)).alias("outdated"))
    return held if distrusted is None else held.join(distrusted.select(by, "revision").distinct(), [by, "revision"], "left_anti").select(by, *others, "outdated")


def repair_plan(log: DataFrame, held: DataFrame, by: str = "partition") -> DataFrame:
    """by, action, sides for partitions whose last line is `updating`, a write that never ended.

    undo sides: the last stocked line, however many marks follow it, is of the same rendering (grain, bundle) and version, and all that
    the new line has besides are versions of neighbours it was without: those sides' files go, and the stocked line holds again.
    drop: anything else of which the store (held: by) has files. Of what the store has nothing, there is nothing to put right.
    """
    facts = ["grain", "bundle", "version", "pre_version", "post_version"]
    stocked = F.when(F.col("state") == "stocked", F.col("line"))
    last = log.groupBy(by).agg(F.max_by(F.struct("state", *facts), "line").alias("_now"), F.max_by(F.struct(*facts), stocked).alias("_was"))
    same = F.lit(True)
    for c in facts[:3]:
        same = same & F.col(f"_was.{c}").eqNullSafe(F.col(f"_now.{c}"))
    for c in facts[3:]:
        same = same & (F.col(f"_was.{c}").eqNullSafe(F.col(f"_now.{c}")) | (F.col(f"_was.{c}") == MISSING))
    came = lambda side: F.when((F.col(f"_was.{side}_version") == MISSING) & ~F.col(f"_now.{side}_version").eqNullSafe(F.lit(MISSING)), F.lit(side))
    sides = F.when(F.col("_was").isNotNull() & F.coalesce(same, F.lit(False)), F.array_compact(F.array(came("pre"), came("post")))).otherwise(F.array().cast("array<string>"))
    left = last.filter("_now.state = 'updating'").withColumn("sides", sides)
    left = left.join(held.select(by).distinct().withColumn("_held", F.lit(True)), by, "left")
    action = F.when(F.size("sides") > 0, "undo sides").when(F.col("_held"), "drop")
    return left.select(by, action.alias("action"), "sides").filter("action IS NOT NULL")


#: What a partition of the archives is named by.
PARTITION = ["venue", "market", "dataset", "variant", "bundle", "grain", "month"]


def archive_files(listing: DataFrame) -> DataFrame:
    """PARTITION and size of the files of a listing (path, length) of the archives. Names that are no archive keys, as those of downloads in progress and backups, are of no partition."""
    named = parse_keys(listing.select("length", F.element_at(F.split("path", "/"), -1).alias("_name")), "_name")
    # a row of its own for each name: else an aggregate of these takes in the whole grammar of names once a column
    return named.select(F.inline(F.array(F.struct(*PARTITION, F.col("length").alias("size"))))).filter("month IS NOT NULL")


def matches_catalog(stored: DataFrame, partitions: DataFrame, by: list[str] = PARTITION) -> DataFrame:
    """partitions (by, files, bytes) with verdict: complete (as many files and bytes are stored; names are not compared one by one), absent (none is) or incomplete."""
    joined = partitions.join(partition_files(stored, by), by, "left")
    held = F.coalesce("held_files", F.lit(0))
    same = (held == F.col("files")) & (F.coalesce("held_bytes", F.lit(0)) == F.col("bytes"))
    return joined.withColumn("verdict", F.when(same, "complete").when(held == 0, "absent").otherwise("incomplete")).drop("held_files", "held_bytes")


def reconcile_store(catalog: DataFrame, store: DataFrame) -> DataFrame:
    """path, verdict of every file in either: missing, resized, orphaned or equal; renamed where a missing file's tag and size are an orphan's."""
    c = catalog.select("path", F.col("size").alias("c_size"), F.col("etag").alias("c_etag"))
    s = store.select("path", F.col("size").alias("s_size"), F.col("etag").alias("s_etag"))
    both = c.join(s, "path", "full_outer").withColumn("verdict", F.when(F.col("s_size").isNull(), "missing").when(F.col("c_size").isNull(), "orphaned").when(F.col("c_size") != F.col("s_size"), "resized").otherwise("equal"))
    orphans = both.filter("verdict = 'orphaned'").select(F.col("s_size").alias("c_size"), F.col("s_etag").alias("c_etag")).distinct().withColumn("_moved", F.lit(True))
    # only what is missing meets the orphans by its tag
    lost = both.filter("verdict = 'missing'").select("path", "c_size", "c_etag").join(orphans, ["c_size", "c_etag"], "left")
    return both.filter("verdict <> 'missing'").select("path", "verdict").unionByName(lost.select("path", F.when(F.col("_moved"), "renamed").otherwise("missing").alias("verdict")))


def plan_diff(ready: DataFrame, held: DataFrame, by: list[str]) -> DataFrame:
    """ready with plan: new, changed or unchanged against what is held, by version."""
    joined = ready.join(held.select(*by, F.col("version").alias("_held")), by, "left")
    return joined.withColumn("plan", F.when(F.col("_held").isNull(), "new").when(F.col("_held") != F.col("version"), "changed").otherwise("unchanged")).drop("_held")


def decide(renderings: DataFrame, ledger: DataFrame) -> DataFrame:
    """key, status, partition, sides: what is to be done about each month, and from which rendering.

    renderings: key, partition, rank (lowest preferred), files, version, versions, fields, on_disk (its files are there as
    the catalog has them), edges (its neighbours: structs of id, side, version, here) and missing (sides without a neighbour).
    ledger: key, partition, version, revision, lacking (the sides it was stocked without); at most one row a key.

    current    stocked at a revision that a rendering has now
    waiting    no rendering has files
    complete   nothing has changed but that a neighbour came: only the sides are to be made, and its files are here
    stock      not stocked; restock: stocked at another revision; both from the first rendering that is on disk with its neighbours
    pending    a neighbour came, but its files are not here
    outdated   stocked at another revision, and no rendering is on disk
    missing    not stocked, and no rendering is on disk
    """
    held = ledger.select("key", F.col("partition").alias("_p"), F.col("version").alias("_v"), F.col("revision").alias("_r"), F.coalesce("lacking", F.array().cast("array<string>")).alias("_lacking"))
    joined = renderings.filter("files > 0").join(held, "key", "left")
    came = F.filter("edges", lambda e: F.array_contains("_lacking", e["side"]))
    others = F.filter("edges", lambda e: ~F.array_contains("_lacking", e["side"]))
    made = lambda edges, missing: revision(F.col("versions"), F.col("fields"), F.col("partition"), F.col("version"), edges, missing)
    same = (F.col("_p") == F.col("partition")) & (F.col("_v") == F.col("version"))
    arrived = F.coalesce(same & (F.size(came) > 0) & (made(others, F.col("_lacking")) == F.col("_r")), F.lit(False))
    here = lambda edges: F.forall(edges, lambda e: e["here"])
    able = F.when(arrived, here(came)).otherwise(F.col("on_disk") & here(F.col("edges")))
    marked = joined.select(
        "key", "partition", "rank", F.coalesce(made(F.col("edges"), F.col("missing")) == F.col("_r"), F.lit(False)).alias("_current"), arrived.alias("_arrived"), able.alias("_able"),
        F.col("_r").isNotNull().alias("_stocked"), F.array_sort(F.transform(came, lambda e: e["side"])).alias("_sides"))
    first = F.when(F.col("_able"), F.col("rank"))
    by_key = marked.groupBy("key").agg(
        F.bool_or("_current").alias("_current"), F.bool_or("_stocked").alias("_stocked"), F.bool_or("_arrived").alias("_any"),
        F.min_by(F.struct("partition", "_arrived", "_sides"), first).alias("_pick"), F.min(first).alias("_found"))
    all_keys = renderings.select("key").distinct().join(by_key, "key", "left")
    picked = F.col("_found").isNotNull()
    status = (F.when(F.col("_current").isNull(), "waiting").when(F.col("_current"), "current").when(picked & F.col("_pick._arrived"), "complete").when(picked & F.col("_stocked"), "restock")
              .when(picked, "stock").when(F.col("_stocked") & F.col("_any"), "pending").when(F.col("_stocked"), "outdated").otherwise("missing"))
    act = status.isin("complete", "stock", "restock")
    return all_keys.select("key", status.alias("status"), F.when(act, F.col("_pick.partition")).alias("partition"), F.when(status == "complete", F.col("_pick._sides")).alias("sides"))


def validate_ledger(ledger: DataFrame, files: DataFrame, backups: DataFrame) -> DataFrame:
    """partition, finding of ledger rows (count, size, revision) that the store does not bear out and no backup of that revision has."""
    held = files.groupBy("partition").agg(F.count("*").alias("_n"), F.sum("size").alias("_bytes"))
    found = ledger.join(held, "partition", "left").withColumn(
        "finding", F.when(F.col("_n").isNull(), "gone").when(F.col("_n") != F.col("count"), "wrong count").when(F.col("_bytes") != F.col("size"), "wrong bytes"))
    return found.filter("finding IS NOT NULL").join(backups, ["partition", "revision"], "left_anti").select("partition", "finding")


def record_findings(stored: DataFrame, records: DataFrame, ledger: DataFrame, told: DataFrame) -> DataFrame:
    """partition, revision, finding over what cold storage holds and what is written down of it.

    stored: a row for each file there (partition, revision). records: revisions written down as whole (partition, revision,
    count). ledger: the revisions that are stocked now. told: those that the vault knows to have a copy.
    not stored and another number of files: written down as whole and not so; unrecorded: every file of the ledger's
    revision is there (as many as its `count`) and it is not written down; untold: whole at the ledger's revision, and the vault was not told.
    """
    both = ["partition", "revision"]
    held = stored.groupBy(*both).agg(F.count("*").alias("_files"))
    wrong = records.join(held, both, "left").withColumn("finding", F.when(F.col("_files").isNull(), "not stored").when(F.col("_files") != F.col("count"), "another number of files"))
    whole = ledger.join(held, both).filter("_files = count").join(records.select(*both), both, "left_anti").withColumn("finding", F.lit("unrecorded"))
    untold = ledger.select(*both).join(records.select(*both), both, "left_semi").join(told.select(*both), both, "left_anti").withColumn("finding", F.lit("untold"))
    return wrong.filter("finding IS NOT NULL").select(*both, "finding").unionByName(whole.select(*both, "finding")).unionByName(untold.select(*both, "finding"))


def needed(wanted: DataFrame, here: DataFrame, catalog: DataFrame, elsewhere: DataFrame, by: list[str]) -> DataFrame:
    """by, rendering: what is waited for (by, rendering it was recorded with) and not here, and the rendering of it that is stored
    elsewhere at the version the catalog has: the recorded one before others, then the first by name; null if none is."""
    absent = wanted.join(here.select(*by).distinct(), by, "left_anti")
    held = elsewhere.select(*by, F.col("rendering").alias("_other"), "version").join(catalog.select(*by, F.col("rendering").alias("_other"), "version"), [*by, "_other", "version"], "left_semi")
    order = F.when(F.col("_other").isNotNull(), F.struct(F.col("_other") != F.col("rendering"), F.col("_other")))
    return absent.join(held.select(*by, "_other"), by, "left").groupBy(*by).agg(F.min_by("_other", order).alias("rendering"))


def coverage(parts: DataFrame) -> DataFrame:
    """venue (null: all), months, whole (months with all parts sent), parts, bytes, sent, share (sum over months of sent parts / parts)."""
    by = parts.groupBy("venue", "month").agg(F.count("*").alias("parts"), F.sum("size").alias("bytes"), F.count_if(F.col("uploaded")).alias("sent"))
    out = by.rollup("venue").agg(F.count("*").alias("months"), F.count_if(F.col("sent") == F.col("parts")).alias("whole"), F.sum("parts").alias("parts"), F.sum("bytes").alias("bytes"), F.sum("sent").alias("sent"), F.sum(F.col("sent") / F.col("parts")).alias("share"))
    return out.withColumn("share", F.round("share", 6))


def backed_months(parts: DataFrame) -> DataFrame:
    return parts.groupBy("venue", "month").agg(F.bool_and("uploaded").alias("backed"))


def month_bytes(parts: DataFrame) -> DataFrame:
    return parts.groupBy("venue", "month").agg(F.sum("size").alias("bytes"))


def duplicated(parts: DataFrame, key: str = "path") -> DataFrame:
    return parts.groupBy(key).agg(F.count("*").alias("places")).filter("places > 1")


def cold_stats(parts: DataFrame) -> DataFrame:
    return parts.groupBy("venue").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min("month").alias("first"), F.max("month").alias("last"))


def coverage_gaps(held: DataFrame, by: list[str]) -> DataFrame:
    """by, month for the months between the first and the last that are not held."""
    from marketloom.operators.catalog import missing_periods, months_between

    span = held.groupBy(*by).agg(F.min("month").alias("first"), F.max("month").alias("last"))
    return missing_periods(months_between(span, by), held, [*by, "month"])


def coverage_findings(catalog: DataFrame, store: DataFrame, by: list[str]) -> DataFrame:
    """finding, by, month, files: months missing between the first and the last (gap), files stored that the catalog has not
    (orphans), files of another size (sizes), and months catalogued and not stored, the newest excused (lag). Both have by, month, path, size and etag."""
    key = [*by, "month"]
    gaps = coverage_gaps(store, by).select(F.lit("gap").alias("finding"), *key, F.lit(0).cast("long").alias("files"))
    lag = stage_lag(catalog, store, by).select(F.lit("lag").alias("finding"), *key, F.lit(0).cast("long").alias("files"))
    held = store.select("path", "size", *key).join(catalog.select("path", F.col("size").alias("_size"), F.lit(True).alias("_known")), "path", "left")
    finding = F.when(F.col("_known").isNull(), "orphans").when(F.col("size") != F.col("_size"), "sizes")
    files = held.select(finding.alias("finding"), *key).filter("finding IS NOT NULL").groupBy("finding", *key).agg(F.count("*").alias("files"))
    return gaps.unionByName(lag).unionByName(files)


def partition_files(files: DataFrame, by: list[str]) -> DataFrame:
    """by, held_files, held_bytes of the files on storage."""
    return files.groupBy(*by).agg(F.count("*").alias("held_files"), F.sum("size").alias("held_bytes"))


def stage_lag(ahead: DataFrame, behind: DataFrame, by: list[str], spills: Column | None = None) -> DataFrame:
    """Months that one stage has and the next has not; the newest is excused where it still waits for its neighbour."""
    newest = ahead.groupBy(*by).agg(F.max("month").alias("_newest"))
    left = ahead.select(*by, "month").distinct().join(behind.select(*by, "month").distinct(), [*by, "month"], "left_anti").join(newest, by)
    excused = (F.col("month") == F.col("_newest")) & (spills if spills is not None else F.lit(True))
    return left.filter(~excused).drop("_newest")


def spill_reach(partitions: DataFrame, spill: str = "back") -> DataFrame:
    """partition, neighbour, side for each neighbour that a spilling partition needs: by one month on its first period (back), one before its last
    (forward); neighbour is null where it is missing."""
    from marketloom.operators.catalog import neighbours

    out = None
    for by, side in [x for x, on in (((1, "first"), spill != "forward"), ((-1, "last"), spill != "back")) if on]:
        part = neighbours(partitions, by).select("partition", "neighbour", F.lit(side).alias("side"))
        out = part if out is None else out.unionByName(part)
    return out


def drop_overlap(side_rows: DataFrame, own_rows: DataFrame, side: str) -> DataFrame:
    """Rows of a side file beyond the reach of the month's own rows, by symbol; all of them where it has none."""
    reach = own_rows.groupBy("symbol").agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    joined = side_rows.join(reach, "symbol", "left")
    beyond = F.col("ts") > F.col("_last") if side == "post" else F.col("ts") < F.col("_first")
    return joined.filter(F.col("_first").isNull() | beyond).drop("_first", "_last")


def sides_of_own(side_rows: DataFrame, own_rows: DataFrame) -> DataFrame:
    return side_rows.join(own_rows.select("symbol").distinct(), "symbol", "left_semi")


def pack_batches(partitions: DataFrame, cap: int) -> DataFrame:
    """partition, batch: bins of at most cap bytes in each venue and month, heaviest first into the first that has room; one that is over the
    cap has a bin of its own. A month of a venue is a group of bounded size: as many rows as the venue has slices."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "partition"], ascending=[False, True])
        room: list[int] = []
        batch = []
        for size in group["bytes"]:
            at = next((i for i, left in enumerate(room) if left >= size), None)
            if at is None:
                at = len(room)
                room.append(cap)
            room[at] -= size
            batch.append(at)
        return group.assign(batch=batch)[["venue", "month", "partition", "bytes", "batch"]]

    rows = partitions.select("venue", "month", "partition", F.col("bytes").cast("long").alias("bytes"))
    return rows.groupBy("venue", "month").applyInPandas(fit, "venue string, month string, partition string, bytes long, batch int")


def partition_stats(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last"))
