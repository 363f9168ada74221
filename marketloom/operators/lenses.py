"""Lenses: subsets of partitions by include and exclude rules, and their month intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ends that stand for open ones.
FIRST, LAST = "000001", "999912"
SIBLING = ["venue", "market", "dataset", "variant", "month"]


def month_index(month: Column) -> Column:
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 5, 2).cast("int") - 1


def month_text(index: Column) -> Column:
    return F.concat(F.lpad(F.floor(index / 12).cast("string"), 4, "0"), F.lpad((index % 12 + 1).cast("string"), 2, "0"))


def _closed(spans: DataFrame) -> DataFrame:
    return spans.withColumn("_a", month_index(F.coalesce("from", F.lit(FIRST)))).withColumn("_b", month_index(F.coalesce("to", F.lit(LAST))))


def _opened(spans: DataFrame, by: list[str]) -> DataFrame:
    return spans.select(*by, F.nullif(month_text(F.col("_a")), F.lit(FIRST)).alias("from"), F.nullif(month_text(F.col("_b")), F.lit(LAST)).alias("to"))


def span_union(spans: DataFrame, by: list[str]) -> DataFrame:
    """The union of month spans (from, to; null is open), by group: spans that overlap are one, and spans that only
    adjoin stay apart. Equal spans are of one island, in whatever order they come."""
    order = Window.partitionBy(*by).orderBy("_a", "_b")
    reach = F.max("_b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = _closed(spans).withColumn("_new", (reach.isNull() | (reach < F.col("_a"))).cast("int"))
    islands = marked.withColumn("_island", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return _opened(islands.groupBy(*by, "_island").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b")), by)


def span_minus(spans: DataFrame, cuts: DataFrame, by: list[str]) -> DataFrame:
    """Spans less the months of the cuts: each is trimmed, split or swallowed. Spans are taken as disjoint.

    A span is cut at the union of the cuts that meet it: the pieces are what lies before, between and after them.
    """
    held = _closed(spans).select(*by, F.col("_a"), F.col("_b"))
    merged = _closed(span_union(cuts, by)).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_a", "_b"))).alias("_cuts"))
    joined = held.join(merged, by, "left")
    met = F.filter(F.coalesce("_cuts", F.array().cast("array<struct<_a:int,_b:int>>")), lambda c: (c["_b"] >= F.col("_a")) & (c["_a"] <= F.col("_b")))
    joined = joined.withColumn("_met", met)
    starts = F.concat(F.array("_a"), F.transform("_met", lambda c: c["_b"] + 1))
    stops = F.concat(F.transform("_met", lambda c: c["_a"] - 1), F.array("_b"))
    pieces = F.filter(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: p["a"] <= p["b"])
    return _opened(joined.select(*by, F.explode(pieces).alias("p")).select(*by, F.col("p.a").alias("_a"), F.col("p.b").alias("_b")), by)


def span_holds(date: Column, start: Column, end: Column) -> Column:
    """Whether a stamp of any grain is in a month span."""
    month = F.substring(date, 1, 6)
    return (start.isNull() | (month >= start)) & (end.isNull() | (month <= end))


def match_rules(partitions: DataFrame, rules: DataFrame) -> DataFrame:
    """partition x rule where the rule covers it. rules (rule, effect, venue or *, markets array, datasets array of
    (dataset, variant), only_grain, only_bundle, prefer_grain, prefer_bundle, from, to; null leaves a choice
    open) are written by hand, a few dozen at most, so they are broadcast and each partition is held against each rule."""
    p, r = partitions.alias("p"), rules.alias("r")
    kinds = F.exists("r.datasets", lambda d: (d["dataset"] == F.col("p.dataset")) & (d["variant"].isNull() | (d["variant"] == F.col("p.variant"))))
    covers = (
        ((F.col("r.venue") == "*") | (F.col("r.venue") == F.col("p.venue"))) & (F.col("r.markets").isNull() | F.array_contains("r.markets", F.col("p.market")))
        & (F.col("r.datasets").isNull() | kinds) & (F.col("r.only_grain").isNull() | (F.col("r.only_grain") == F.col("p.grain")))
        & (F.col("r.only_bundle").isNull() | (F.col("r.only_bundle") == F.col("p.bundle"))) & span_holds(F.col("p.month"), F.col("r.from"), F.col("r.to")))
    return p.join(F.broadcast(r), covers).select("p.*", "r.rule", "r.effect", "r.prefer_bundle", "r.prefer_grain")


def prefer(matched: DataFrame, form: str, choice: str, by: list[str] = SIBLING) -> DataFrame:
    """matched rows of the preferred form where any sibling has it, all of them where none has."""
    w = Window.partitionBy("rule", *by)
    has = F.max(F.coalesce(F.col(form) == F.col(choice), F.lit(False))).over(w)
    return matched.withColumn("_has", has).filter(~F.col("_has") | (F.col(form) == F.col(choice))).drop("_has")


def apply_rules(matched: DataFrame, columns: list[str]) -> DataFrame:
    """What the includes let through and no exclude covers, whatever their order."""
    held = prefer(prefer(matched.filter("effect = 'include'"), "bundle", "prefer_bundle"), "grain", "prefer_grain")
    out = matched.filter("effect = 'exclude'").select(*columns)
    return held.select(*columns).distinct().join(out.distinct(), columns, "left_anti")


def resolve_lens(partitions: DataFrame, rules: DataFrame) -> DataFrame:
    """The partitions of a lens (rows of partitions, which has partition and the traits)."""
    return partitions.join(apply_rules(match_rules(partitions, rules), ["partition"]), "partition", "left_semi")


def resolve_new(partitions: DataFrame, fresh: DataFrame, rules: DataFrame) -> DataFrame:
    """The lens among the siblings of fresh partitions, which are decided together."""
    return resolve_lens(partitions.join(fresh.select(*SIBLING).distinct(), SIBLING, "left_semi"), rules)


def lens_changes(kept: DataFrame, held: DataFrame) -> DataFrame:
    """partition, change: add what is kept and not held, remove what is held and not kept."""
    add = kept.select("partition").join(held.select("partition"), "partition", "left_anti").withColumn("change", F.lit("add"))
    return add.unionByName(held.select("partition").join(kept.select("partition"), "partition", "left_anti").withColumn("change", F.lit("remove")))


def lens_slices(slices: DataFrame, rules: DataFrame) -> DataFrame:
    """slice, from, to: the months that a draft lens leaves each slice (venue, market, dataset, variant, grain, bundle)."""
    any_month = slices.withColumn("month", F.lit(None).cast("string"))
    open_rules = rules.withColumns({"_from": F.col("from"), "_to": F.col("to"), "from": F.lit(None).cast("string"), "to": F.lit(None).cast("string")})
    hits = match_rules(any_month, open_rules).select("slice", "rule", "effect").join(rules.select("rule", "from", "to"), "rule")
    plus = span_union(hits.filter("effect = 'include'").select("slice", "from", "to"), ["slice"])
    return span_minus(plus, hits.filter("effect = 'exclude'").select("slice", "from", "to"), ["slice"])


def through_lens(series: DataFrame, spans: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """series (slice, series, first, last) cut to the months of the lens: one row for each span it meets. By their bounds alone, or
    with files (slice, series, date) exactly: to the first and last file in the span, and left out if there is none with a date."""
    joined = series.join(spans, "slice")
    if files is not None:
        held = files.select("slice", "series", "date").join(spans, "slice").filter(span_holds(F.col("date"), F.col("from"), F.col("to")))
        return held.groupBy("slice", "series", "from", "to").agg(F.min("date").alias("first"), F.max("date").alias("last")).filter(F.col("first").isNotNull()).select("slice", "series", "first", "last")
    first = F.greatest(F.col("first"), F.coalesce("from", F.lit(FIRST)))
    last = F.least(F.col("last"), F.concat(F.coalesce("to", F.lit(LAST)), F.lit("99")))
    return joined.select("slice", "series", first.alias("first"), last.alias("last")).filter(F.substring("first", 1, 6) <= F.substring("last", 1, 6))


def lens_figures(members: DataFrame, partitions: DataFrame) -> DataFrame:
    """venue (null: all), partitions, files, bytes of a lens."""
    return partitions.join(members.select("partition").distinct(), "partition", "left_semi").rollup("venue").agg(F.count("*").alias("partitions"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by name, without regard to the case of names; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select(*[F.col(c).alias(c.lower()) for c in f.columns]) for f in frames])
