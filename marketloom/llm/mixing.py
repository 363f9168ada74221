"""Sources mixed to target weights by soft membership.

A classifier learnt from a labelled table gives every document a posterior over the domains.
Each document then gets a rate, how often it is to be read: the rates nearest to one, by
squares weighted with tokens, that are not below a bound (zero, unless set) and whose expected
tokens of each domain, sum of rate x tokens x posterior, equal the targets. The rates have the
form max(bound, 1 + posterior . c) with one number c for each domain, so each projected
gradient step is one distributed sum over the documents and a step of c in the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import drop_stored, fresh, small_batches, stored

#: The classifier's bounds: labelled rows and words it is fitted on; and how sharp its posteriors are.
SAMPLE, WORDS, SHARPNESS = 4_000, 20_000, 2.0


class Domains:
    """Words' log likelihoods by domain, and the domains' log shares."""

    def __init__(self, names: list[str], prior: np.ndarray, words: dict[str, int], likelihood: np.ndarray):
        self.names, self.prior, self.words, self.likelihood = names, prior, words, likelihood

    def posterior(self, words: list[str]) -> np.ndarray:
        """Softmax of log share plus the sharpened mean log likelihood of the words known."""
        found = [i for i in map(self.words.get, words) if i is not None]
        z = self.prior.copy()
        if found:
            z += SHARPNESS * self.likelihood[found].mean(axis=0)
        z = np.exp(z - z.max())
        return z / z.sum()


def fit_domains(docs: DataFrame, labelled: DataFrame, domain: str = "domain") -> Domains:
    """Naive Bayes on about SAMPLE labelled rows (doc_id, domain): of every domain as many, by a hash of their id, and all
    rows of one that has fewer, so that the rarest has its own. The shares are those of all labelled rows.

    Rows without an id or a domain are left out; of several domains of one id the first by name counts. The
    WORDS most frequent words of the sample are used, a bound of the model.
    """
    rows = labelled.filter(F.col("doc_id").isNotNull() & F.col(domain).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col(domain).cast("string")).alias("domain"))
    shares = rows.groupBy("domain").agg(F.count("*").alias("n")).orderBy("domain").collect()  # a row a domain
    each = -(-SAMPLE // max(1, len(shares)))
    cuts = docs.sparkSession.createDataFrame([(r["domain"], min(1.0, each / r["n"])) for r in shares], "domain string, share double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.join(F.broadcast(cuts), "domain").filter(place < F.col("share")).drop("share")  # about SAMPLE rows whatever the input, so it can be broadcast
    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(picked), "doc_id").select("domain", "text")
    sample = stored(sample)
    names = [r["domain"] for r in shares]
    if not names:
        return Domains(["all"], np.zeros(1), {}, np.zeros((0, 1)))
    at = {x: i for i, x in enumerate(names)}
    prior = np.zeros(len(names))
    for r in shares:
        prior[at[r["domain"]]] = r["n"]
    counts = sample.select("domain", F.explode(F.split("text", r"\s+")).alias("word")).filter("word <> ''").groupBy("word", "domain").agg(F.count("*").alias("n"))
    by_word = counts.groupBy("word").agg(F.sum("n").alias("all"), F.collect_list(F.struct("domain", "n")).alias("by"))
    top = by_word.orderBy(F.desc("all"), "word").limit(WORDS).collect()
    table = np.full((len(top), len(names)), 0.5)
    for i, r in enumerate(top):
        for x in r["by"]:
            table[i, at[x["domain"]]] += x["n"]
    drop_stored(sample)
    return Domains(names, np.log(prior / prior.sum()), {r["word"]: i for i, r in enumerate(top)}, np.log(table / table.sum(axis=0)) if len(top) else np.zeros((0, len(names))))


def memberships(docs: DataFrame, domains: Domains) -> DataFrame:
    """docs' rows, all columns kept, with tokens (words) and posterior (array of doubles by domain)."""
    small_batches(docs.sparkSession)
    base = docs.drop("tokens", "posterior")
    sent = docs.sparkSession.sparkContext.broadcast(domains)

    def run(batches):
        model = sent.value
        for batch in batches:
            words = [x.as_py().lower().split() for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(x) for x in words], pa.int64()), pa.array([model.posterior(x).tolist() for x in words], pa.list_(pa.float64()))],
                names=[*batch.schema.names[:-1], "tokens", "posterior"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema.fields)
    return base.withColumn(fresh(base, "_words"), F.coalesce(F.col("text"), F.lit(""))).mapInArrow(run, f"{schema}tokens long, posterior array<double>")


def rate_of(c: list[float], least: float) -> Column:
    dot = sum((F.col("posterior")[i] * F.lit(x) for i, x in enumerate(c)), F.lit(1.0))
    return F.greatest(F.lit(least), dot)


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0, rounds: int = 50, close: float = 1e-9) -> tuple[list[float], float]:
    """The numbers c for which the rates max(least, 1 + posterior . c) meet the targets, and by which share of all
    tokens they miss them.

    members: tokens and posterior of every document; targets: expected tokens of each domain. The
    step is a gradient in the metric of the first round's second moments, which bounds the
    curvature, so every step is a descent. Targets that no rates meet (nothing of a domain to which
    documents of another belong in part) leave a miss.
    """
    k = len(targets)
    p = [F.col("posterior")[i] for i in range(k)]
    moments = members.agg(*[F.sum(F.col("tokens") * p[i] * p[j]) for i in range(k) for j in range(k)]).first()
    metric = np.array([x or 0.0 for x in moments]).reshape(k, k)
    step = np.linalg.pinv(metric, rcond=1e-9, hermitian=True)
    c, goal = np.zeros(k), np.array(targets)
    for n in range(rounds + 1):
        got = members.agg(*[F.sum(F.col("tokens") * rate_of(c.tolist(), least) * x) for x in p]).first()
        gap = goal - np.array([x or 0.0 for x in got])
        miss = float(np.abs(gap).sum() / max(1.0, goal.sum()))
        if miss <= close or n == rounds:
            break
        c = c + step @ gap
    return [round(x, 12) for x in c.tolist()], miss


def flatter(shares: np.ndarray, power: float = 0.7) -> np.ndarray:
    """Target weights: the shares to a power below one, so that small domains gain."""
    out = np.where(shares > 0, shares, 0) ** power
    return out / out.sum() if out.sum() else shares


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, least: float = 0.0, most_miss: float | None = 1e-3, keep: list[str] | None = None) -> DataFrame:
    """docs' rows, all columns kept (or those of keep), with tokens, posterior, domain (the likeliest, the first of equals by
    name), rate and copies. Columns of these names in docs are replaced.

    weights: the target share of each domain (a domain not named gets none); by default the shares as
    they are, flattened. Targets that are missed by over most_miss of all tokens are an error, unless it is
    None. With least = 0 the tokens in all stay as they are; with least > 0 the rates
    are scaled up until the lowest domain's is that, which keeps the shares (if a domain is to have
    nothing, its rates stop at least instead). copies is the rate rounded
    down or up by a hash of the row, so that the expected copies are the rate, and repeated rows have equal
    ones. A null text has no tokens and the domains' shares as posterior; an empty table gives no rows.
    """
    domains = fit_domains(docs, labelled)
    k = len(domains.names)
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    own = docs.drop("domain", "rate", "copies", "tokens", "posterior")
    part = fresh(own, "_unit")
    kept = [c for c in own.columns if keep is None or c in keep]
    # one pass over the texts: what follows reads the table
    members = stored(memberships(own.withColumn(part, unit), domains).select(*kept, part, "tokens", "posterior"))
    sums = members.agg(*[F.sum(F.col("tokens") * F.col("posterior")[i]) for i in range(k)]).first()
    now = np.array([x or 0.0 for x in sums])
    shares = now / now.sum() if now.sum() else np.full(k, 1 / k)
    want = np.array([weights.get(x, 0.0) for x in domains.names]) if weights else flatter(shares)
    c, miss = fit_rates(members, (want * now.sum()).tolist())
    if most_miss is not None and miss > most_miss:
        raise ValueError(f"the targets are missed by {miss:.3g} of all tokens")
    low = 1 + min(c)
    if least > 0 and low > 0:  # posteriors sum to one, so a rate is a mean of the domains' rates 1 + c
        c = [least / low * (1 + x) - 1 for x in c]
    rated = members.withColumn("rate", F.round(rate_of(c, least), 9))
    domain = F.element_at(F.array(*[F.lit(x) for x in domains.names]), F.array_position("posterior", F.array_max("posterior")).cast("int"))
    copies = (F.floor("rate") + (F.col(part) < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    return rated.withColumn("domain", domain).withColumn("copies", copies).drop(part)


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, domain of the documents that the labels table covers: their language."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("domain")).join(ids, "doc_id", "left_semi")


def repeat_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as its copies say; none for no copies."""
    rows = mixed.filter("copies > 0")
    return rows.withColumn(fresh(rows, "_copy"), F.explode(F.array_repeat(F.lit(True), F.col("copies")))).select(*columns)
