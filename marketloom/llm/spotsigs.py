"""SpotSigs: fingerprints made of the content words that follow common words.

Wherever a content word follows a common word (the anchor), the anchor and the chain of
content words from there on are a signature, whatever common words lie between. A text's
fingerprint is the sorted set of its signatures' short digests. Likeness is the Jaccard
similarity of two sets. Everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import components, stored

# Common words of four languages that anchor signatures.
ANCHORS = (
    "a an and are as at be by for from has in is it of on or that the this to was were will with "
    "der die das den dem ein eine einer und ist in zu mit von auf für nicht sich auch als an es im "
    "le la les un une des du de et est en que qui dans pour par sur au aux ce se plus ne pas "
    "el la los las una unos de del y en que es por para con se al lo como su no"
).split()
CHAIN = 3
DIGITS = 8
NOT_WORD = r"[^a-z0-9\x{C0}-\x{1FFF}\x{2070}-\x{2FFF}\x{3040}-\x{10FFFF}]+"


def _tokens(text: Column) -> Column:
    """Content words in order, each with the common words right before it and a plus after each of those."""
    low = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))
    marked = F.transform(F.split(low, " "), lambda w: F.concat(w, F.when(w.isin(sorted(set(ANCHORS))), "+").otherwise(" ")))
    return F.split(F.rtrim(F.array_join(marked, "")), " ")


def _digest(x: Column) -> Column:
    return F.substring(F.md5(x.cast("binary")), 1, DIGITS)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the fingerprint of `text` in `out`: sorted distinct digests, a comma apart.

    A text without a signature has one digest, of all its words; so equal texts have equal
    fingerprints, and texts of different words differ. A null text counts as empty.
    """
    step = df.withColumn("_tokens", _tokens(F.col(text)))
    word = lambda x: F.substring_index(x, "+", -1)
    step = step.withColumn("_content", F.transform("_tokens", word))
    rest = lambda k: F.slice("_content", k, F.size("_content"))
    pairs = F.zip_with("_tokens", rest(2), lambda x, second: F.struct(x.alias("x"), second.alias("second")))
    chains = F.zip_with(pairs, rest(3), lambda p, third: F.when(
        F.contains(p["x"], F.lit("+")) & (third != ""),
        F.concat_ws(":", F.substring_index(F.substring_index(p["x"], "+", -2), "+", 1), word(p["x"]), p["second"], third)))
    found = F.transform(F.filter(chains, lambda x: x.isNotNull()), _digest)
    step = step.withColumn("_found", F.array_sort(F.array_distinct(found)))
    alone = _digest(F.array_join("_tokens", " "))
    return step.withColumn(out, F.when(F.size("_found") > 0, F.array_join("_found", ",")).otherwise(alone)).drop("_tokens", "_content", "_found")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints."""
    x, y = F.split(a, ","), F.split(b, ",")
    both = F.size(F.array_intersect(x, y))
    return F.when(a == b, 1.0).otherwise(both / (F.size(x) + F.size(y) - both).cast("double"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """docs with next_<column> for each of columns: the row after it by descending doc_id, and for
    the last row the first. Nulls of doc_id come last, rows of one id in the order of the columns.

    Ids are cut into ranges at quantiles; each range also gets the row that begins the range after
    it, so one shuffle by range suffices and no range needs another.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(key.alias("_key")).agg(F.percentile_approx("_key", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(x) for x in sorted(set(cuts))]) if cuts else F.array().cast("array<long>")
    keyed = docs.withColumn("_key", key).withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col("_key"))))
    # one row for each range
    heads = {r["_range"]: r["head"] for r in keyed.groupBy("_range").agg(F.max("_key").alias("head")).collect()}
    ranges = sorted(heads)
    before = {heads[r]: ranges[(k + 1) % len(ranges)] for k, r in enumerate(ranges)}  # the range whose last row it follows
    guest = F.create_map(*[x for k, r in before.items() for x in (F.lit(k).cast("long"), F.lit(r).cast("int"))])[F.col("_key")] if before else F.lit(None).cast("int")
    places = F.array_compact(F.array(F.struct(F.lit(False).alias("_guest"), F.col("_range").alias("_in")), F.when(guest.isNotNull(), F.struct(F.lit(True).alias("_guest"), guest.alias("_in")))))
    dealt = keyed.withColumn("_place", F.explode(places)).select(*docs.columns, "_key", "_place.*")
    order = Window.partitionBy("_in").orderBy("_guest", F.desc("_key"), *columns)
    return dealt.select(*docs.columns, "_guest", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).filter(~F.col("_guest")).drop("_guest")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for
    every row of docs.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document by descending doc_id. A null text counts as empty; an empty table
    gives no rows; further columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    nexts = with_next(with_fingerprint(rows, "text", "fingerprint"), ["text", "fingerprint"])
    sized = nexts.withColumn("n_chars", F.length("text").cast("long")).withColumn("_half", F.expr("cast(n_chars div 2 as int)"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("_half")).cast("int")), F.substring("next_text", F.lit(1), F.col("_half")))
    done = with_fingerprint(sized.withColumn("edited", edited).drop("text", "next_text"), "edited", "edited_fingerprint")
    return done.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, group_id for every row of docs: the smallest doc_id linked by likeness >= threshold.

    Equal fingerprints are one set. Sets are partitioned by length: a set can only be alike to
    one whose length is within a factor of the threshold. Of a set's signatures, taken rarest
    first, two alike sets share one among the first (length - needed + 1), so only these are
    joined, and pairs are then held to the exact Jaccard similarity.
    """
    marked = stored(with_fingerprint(docs.select("doc_id", "text"), "text", "fingerprint").select("doc_id", "fingerprint"))
    sets = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).select(F.xxhash64("fingerprint").alias("set_id"), "fingerprint", "first"))
    each = sets.select("set_id", F.size(F.split("fingerprint", ",")).alias("n"), F.explode(F.split("fingerprint", ",")).alias("sig"))
    often = each.groupBy("sig").agg(F.count("*").alias("often")).filter("often > 1")
    ranked = each.join(often, "sig").withColumn("rank", F.row_number().over(Window.partitionBy("set_id").orderBy("often", "sig")))
    # signatures of one set alone were left out and would have come first: the rank is counted from them
    missing = each.join(often, "sig", "left_anti").groupBy("set_id").agg(F.count("*").alias("single"))
    prefix = ranked.join(missing, "set_id", "left").filter(F.col("rank") + F.coalesce("single", F.lit(0)) <= F.col("n") - F.ceil(F.col("n") * threshold) + 1).select("set_id", "n", "sig")
    prefix = stored(prefix)
    a, b = prefix.alias("a"), prefix.alias("b")
    pairs = a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.set_id") < F.col("b.set_id")) & (F.col("a.n") >= F.col("b.n") * threshold) & (F.col("b.n") >= F.col("a.n") * threshold))
    pairs = pairs.select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b")).distinct()
    one, two = sets.select(F.col("set_id").alias("a"), F.col("fingerprint").alias("fa")), sets.select(F.col("set_id").alias("b"), F.col("fingerprint").alias("fb"))
    links = pairs.join(one, "a").join(two, "b").filter(likeness(F.col("fa"), F.col("fb")) >= threshold).select("a", "b")
    found = components(links).withColumnRenamed("node", "set_id")
    labels = sets.join(found, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    names = labels.groupBy("component").agg(F.min("first").alias("group_id"))
    return marked.join(labels.join(names, "component").select("fingerprint", "group_id"), "fingerprint").select("doc_id", "group_id")


def _sql_fingerprint(source: str, text: str, out: str, name: str) -> str:
    """CTEs that add `out`, the fingerprint of `text`, to `source` under `name`."""
    anchors = ", ".join(f"'{w}'" for w in sorted(set(ANCHORS)))
    return f"""
{name}1 AS (SELECT *, string_split(rtrim(array_to_string(list_transform(string_split(trim(regexp_replace(lower({text}), '{NOT_WORD}', ' ', 'g')), ' '),
    lambda w: w || CASE WHEN w IN ({anchors}) THEN '+' ELSE ' ' END), ''), ' '), ' ') AS t FROM {source}),
{name}2 AS (SELECT *, list_transform(t, lambda x: split_part(x, '+', -1)) AS c FROM {name}1),
{name}3 AS (SELECT *, list_sort(list_distinct(list_filter(list_transform(range(1, len(t) - 1), lambda i: CASE WHEN contains(t[i], '+') AND c[i + 2] <> ''
    THEN substr(md5(split_part(t[i], '+', -2) || ':' || c[i] || ':' || c[i + 1] || ':' || c[i + 2]), 1, {DIGITS}) END), lambda x: x IS NOT NULL))) AS f FROM {name}2),
{name} AS (SELECT * EXCLUDE (t, c, f), CASE WHEN len(f) > 0 THEN array_to_string(f, ',') ELSE substr(md5(array_to_string(t, ' ')), 1, {DIGITS}) END AS {out} FROM {name}3)"""


def _sql_likeness(a: str, b: str) -> str:
    x, y = f"string_split({a}, ',')", f"string_split({b}, ',')"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE len(list_intersect({x}, {y}))::DOUBLE / (len({x}) + len({y}) - len(list_intersect({x}, {y}))) END"


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_sql_fingerprint('d', 'text', 'fingerprint', 'own')},
n AS (SELECT *, coalesce(lead(text) OVER w, first(text) OVER (ORDER BY doc_id DESC)) AS next_text, coalesce(lead(fingerprint) OVER w, first(fingerprint) OVER (ORDER BY doc_id DESC)) AS next_fingerprint
      FROM own WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, length(text) AS n_chars, fingerprint, next_fingerprint, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited FROM n),
{_sql_fingerprint('e', 'edited', 'edited_fingerprint', 'new')}
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       {_sql_likeness('fingerprint', 'edited_fingerprint')} AS near_edited, {_sql_likeness('fingerprint', 'next_fingerprint')} AS near_next
FROM new
"""
