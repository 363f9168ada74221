"""Change capture on the catalog of files: listing pages, withdrawals, reports, series bounds.

Tables are snapshots: each function takes the state before and gives the state after, or the
rows to append to a history. file rows: venue, path, date, size, etag, modified, existence,
downloaded_at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.times import last_closed, last_settled

KEY = ["venue", "path"]
STATE = ["date", "size", "etag", "modified", "existence", "downloaded_at"]


def listing_actions(files: DataFrame, page: DataFrame) -> DataFrame:
    """The state before (old_*), what the page says (new_*) and action of every path in either.

    created, unchanged, revised (size or tag is another: the file is owed again), restated (only the rest
    differs) or unlisted. What the page leaves null is not known to differ.
    """
    old = files.select(*KEY, *[F.col(c).alias(f"old_{c}") for c in STATE], F.lit(True).alias("_old"))
    new = page.select(*KEY, *[F.col(c).alias(f"new_{c}") for c in STATE if c != "downloaded_at"], F.lit(True).alias("_new"))
    both = old.join(new, KEY, "full_outer")
    differs = lambda c: F.col(f"new_{c}").isNotNull() & ~F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}"))
    known = lambda c: differs(c) & F.col(f"old_{c}").isNotNull()
    action = (F.when(F.col("_new").isNull(), "unlisted").when(F.col("_old").isNull(), "created").when((F.col("old_existence") == "confirmed") & (known("size") | known("etag")), "revised")
              .when(differs("size") | differs("etag") | differs("modified") | differs("date") | differs("existence"), "restated").otherwise("unchanged"))
    return both.withColumn("action", action).drop("_old", "_new")


def merge_listing(files: DataFrame, page: DataFrame) -> DataFrame:
    """files after a listing page, with the action that made each row. A known value is never replaced by an unknown one."""
    rows = listing_actions(files, page)
    kept = {c: F.coalesce(f"new_{c}", f"old_{c}") for c in STATE if c != "downloaded_at"}
    return rows.select(*KEY, *[v.alias(c) for c, v in kept.items()], F.when(F.col("action") == "revised", None).otherwise(F.col("old_downloaded_at")).alias("downloaded_at"), "action")


def revisions(files: DataFrame, page: DataFrame) -> DataFrame:
    """What the files that a page revises were before: rows to append to the history."""
    return listing_actions(files, page).filter("action = 'revised'").select(*KEY, *[F.col(f"old_{c}").alias(c) for c in ("size", "etag", "modified", "downloaded_at")])


def withdraw(files: DataFrame, page: DataFrame, low: str, high: str) -> DataFrame:
    """files after a page over the span of paths from low to high: those in it that were not offered are absent."""
    offered = page.select(*KEY).distinct().withColumn("_offered", F.lit(True))
    venues = page.select("venue").distinct().withColumn("_walked", F.lit(True))
    gone = F.coalesce("_walked", F.lit(False)) & F.col("_offered").isNull() & F.col("path").between(low, high) & (F.col("existence") != "absent")
    joined = files.join(offered, KEY, "left").join(venues, "venue", "left")
    return joined.withColumn("withdrawn", gone).withColumn("existence", F.when(gone, "absent").otherwise(F.col("existence"))).select(*files.columns, "withdrawn")


def learned(parked: DataFrame, probes: DataFrame) -> DataFrame:
    """Parked candidates (venue, path, date, size, etag, modified) with what probes (venue, path, size, etag, modified, existence) say of them, and
    settled: whether a probe answered and size and tag are known now. Probes of what is not parked say nothing."""
    p = probes.select(*KEY, *[F.col(c).alias(f"_{c}") for c in ("size", "etag", "modified", "existence")], F.lit(True).alias("_asked"))
    known = {c: F.coalesce(f"_{c}", c) for c in ("size", "etag", "modified")}
    asked = F.coalesce("_asked", F.lit(False))
    return parked.join(p, KEY, "left").select(*KEY, "date", *[v.alias(c) for c, v in known.items()], F.coalesce("_existence", F.lit("confirmed")).alias("existence"), (asked & known["size"].isNotNull() & known["etag"].isNotNull()).alias("settled"))


def settle(files: DataFrame, parked: DataFrame, probes: DataFrame) -> DataFrame:
    """files after probes of parked candidates: a settled one arrives if its path is new; where the path is held as withdrawn and
    the candidate is not, the row is brought back, keeping its download if size and tag are the same; any other row stays as it is."""
    came = learned(parked, probes).filter("settled").select(*KEY, *[F.col(c).alias(f"new_{c}") for c in STATE if c != "downloaded_at"], F.lit(True).alias("_new"))
    old = files.select(*KEY, *STATE, F.lit(True).alias("_old"))
    both = old.join(came, KEY, "full_outer")
    back = F.col("_old").isNull() | (F.coalesce("_new", F.lit(False)) & (F.col("existence") == "absent") & (F.col("new_existence") != "absent"))
    same = F.col("_old").isNotNull() & F.col("size").eqNullSafe(F.col("new_size")) & F.col("etag").eqNullSafe(F.col("new_etag"))
    return both.select(*KEY, *[F.when(back, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in STATE if c != "downloaded_at"],
                       F.when(~back | same, F.col("downloaded_at")).alias("downloaded_at"))


def apply_report(files: DataFrame, report: DataFrame) -> DataFrame:
    """files after a report (venue, path, outcome, size, etag, at): downloaded marks a file that is owed, failed withdraws one that was
    confirmed absent, mismatched corrects size and tag and leaves the file owed."""
    r = report.select(*KEY, "outcome", F.col("size").alias("_size"), F.col("etag").alias("_etag"), F.col("at").alias("_at"), F.coalesce(F.col("confirmed_absent"), F.lit(False)).alias("_absent"))
    joined = files.join(r, KEY, "left")
    done = (F.col("outcome") == "downloaded") & F.col("downloaded_at").isNull() & (F.col("existence") == "confirmed")
    wrong = F.col("outcome") == "mismatched"
    return joined.select(
        *KEY, "date", F.when(wrong, F.coalesce("_size", "size")).otherwise(F.col("size")).alias("size"), F.when(wrong, F.coalesce("_etag", "etag")).otherwise(F.col("etag")).alias("etag"), "modified",
        F.when((F.col("outcome") == "failed") & F.col("_absent"), "absent").otherwise(F.col("existence")).alias("existence"),
        F.when(wrong, None).when(done, F.col("_at")).otherwise(F.col("downloaded_at")).alias("downloaded_at"))


def reconcile_series(series: DataFrame, files: DataFrame, by: list[str], now: Column) -> DataFrame:
    """series (by, grain, first, last, tip) after their files, with lifted and corrected.

    A series without files goes, whatever its columns say. first and last become what the files hold, wider or narrower. The tip
    only rises: to the newest period that was over 15 days before now, or to the last that the series knew of, where that is newer, but never past
    the newest period that is over, as a file of an open one does not say that it is whole.
    """
    bounds = files.filter("existence <> 'absent'").groupBy(*by).agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    floor, proof = last_settled(F.col("grain"), now), F.when(F.col("last").isNotNull(), F.least("last", last_closed(F.col("grain"), now)))
    tip = F.greatest("tip", floor, proof)
    return series.join(bounds, by).select(
        *by, "grain", F.col("_first").alias("first"), F.col("_last").alias("last"), tip.alias("tip"), (~tip.eqNullSafe(F.col("tip"))).alias("lifted"),
        (~(F.col("first").eqNullSafe(F.col("_first")) & F.col("last").eqNullSafe(F.col("_last")))).alias("corrected"))
