"""Long byte strings that occur more than once, found through longest-previous-factor arrays.

A byte string of `least` bytes is repeated if it also starts anywhere else, in any text. The
suffix order of a corpus cannot be made in one piece, so it is made in blocks that no match
leaves:

1. Every window of `least` bytes has a minimizer: the smallest, leftmost hash of the K-byte
   strings inside it. Equal windows have equal minimizers at equal places, so windows whose
   minimizer occurs once are unique. Consecutive windows with one minimizer are a run, with a
   stretch of text that covers them.
2. Minimizers that occur once are set aside. If all stretches around a minimizer are equal, all
   windows in them are repeated. Only where stretches differ, at the ends of matches, are
   windows looked at one by one: the differing stretches of a minimizer go to one block.
3. In a block, prefix doubling gives the order of the suffixes by their first `least` bytes, equal
   ones in order of position. A suffix's previous smaller position in that order gives its longest
   previous factor: all `least` bytes if the two agree in them, and else no earlier suffix does, as
   nothing lies between equal ones. The next greater position gives the occurrence after it in the same
   way. Factors are cut at `least`: longer ones are not needed and not told apart.

A minimizer with very many differing stretches (CROWD) would make a block too large; its windows
are hashed to 128 bits and counted by a grouped aggregate instead, which splits at any size. Both ways
give the same spans, which the tests hold for CROWD = 0 and for sizes on either side of it. Minimizers
and stretches that hold many of the runs are joined by broadcast (see join_spread).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import drop_stored, join_spread, small_batches, stored, text_bytes
from marketloom.llm.rolling import SLICE, Prefixes, mix

LEAST = 200
K = 40
CROWD = 2048
#: Bytes of stretches that are ordered together.
BLOCK = 1 << 18
#: A second, independent table of byte values, for the other half of a 128-bit hash.
_OTHER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive keys, from running minima of blocks of that width."""
    n = len(keys)
    whole = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    whole[:n] = keys
    rows = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def runs_of(text: bytes, least: int = LEAST):
    """start, windows, anchor, stretch of each run of a text: arrays, a slice of the text at a time."""
    k = min(K, least)
    for at in range(0, len(text) - least + 1, SLICE):
        data = np.frombuffer(text, np.uint8)[at : at + SLICE + least - 1]
        sums = Prefixes(data)
        hashes = sums.windows(k)
        keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        where = (_sliding_least(keys, least - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        windows = np.diff(np.concatenate((first, [len(where)])))
        yield first + at, windows, hashes[where[first]].view(np.int64), sums.runs(first, first + windows + least - 1).view(np.int64)


RUNS = "doc long, row long, start int, windows int, anchor long, stretch long"


def _runs(rows: DataFrame, least: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            docs, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for doc, key, text in zip(docs, keys, batch.column(2)):
                text = text.as_py()
                if len(text) >= least:
                    for start, windows, anchor, stretch in runs_of(text, least):
                        n = len(start)
                        out.append((np.full(n, doc or 0), np.full(n, doc is None), np.full(n, key), start, windows, anchor, stretch))
            if out:
                doc, none, *columns = [np.concatenate(c) for c in zip(*out)]
                kinds = (np.int64, np.int32, np.int32, np.int64, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64(), mask=none), *[pa.array(c.astype(t)) for c, t in zip(columns, kinds)]], names=["doc", "row", "start", "windows", "anchor", "stretch"])

    return rows.mapInArrow(run, RUNS)


def _place() -> Column:
    return F.struct("doc", "row", "start", "windows")



def factor_arrays(stretches: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the stretches, laid end to end: its longest previous factor, cut at `least` (0 for a
    shorter one), and the numbers of the windows that are its source and its next occurrence, -1 for none.

    Prefix doubling ranks the suffixes by 8, 16, ... bytes, the last step by exactly `least`. In the order of
    (rank, position) the suffixes of one rank stand by position, so the previous smaller position of a
    suffix is the neighbour before it, if that has its rank, and the next greater one the neighbour after it.
    """
    data = np.concatenate(stretches)
    n = len(data)
    padded = np.concatenate((data, np.zeros(2 * least, np.uint8)))
    width = min(8, least)
    keys = np.zeros(n + least, np.uint64)
    for j in range(width):
        keys = keys << np.uint64(8) | padded[j : j + n + least]
    rank = np.unique(keys, return_inverse=True)[1]
    while width < least:
        step = min(width, least - width)
        m = len(rank) - step
        rank = np.unique(rank[:m] * np.int64(len(keys)) + rank[step : step + m], return_inverse=True)[1]
        width += step
    ends = np.cumsum([len(s) for s in stretches])
    starts = np.concatenate([np.arange(e - len(s), e - least + 1) for s, e in zip(stretches, ends)])
    own = rank[starts]
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    previous, following = np.full(len(own), -1), np.full(len(own), -1)
    previous[order[1:][same]] = order[:-1][same]
    following[order[:-1][same]] = order[1:][same]
    return np.where(previous >= 0, least, 0), previous, following


def _intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and one past the last of each stretch of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


SPANS = "doc long, row long, start int, stop int"


def _blocks(texts: DataFrame, least: int, keep: str) -> DataFrame:
    """texts: anchor, doc, row, start, alone, body, those of an anchor adjacent. Spans of repeated windows."""

    def run(batches):
        held, size, last = [], 0, None

        def flush():
            held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
            factors, _, following = factor_arrays([np.frombuffer(r[4], np.uint8) for r in held], least)
            flags = factors >= least if keep == "first" else (factors >= least) | (following >= 0)
            at, out = 0, []
            for doc, row, start, alone, body in held:
                n = len(body) - least + 1
                if alone or keep == "first":
                    out += [(doc, row, start + a, start + b - 1 + least) for a, b in _intervals(flags[at : at + n])]
                at += n
            held.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc", "row", "start", "stop"])

        for batch in batches:
            for anchor, doc, row, start, alone, body in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != last and size >= BLOCK:
                    yield from flush()
                    size = 0
                held.append((doc, row, start, alone, body))
                size, last = size + len(body), anchor
        if held:
            yield from flush()

    return texts.mapInArrow(run, SPANS)


def _hashed_windows(texts: DataFrame, least: int) -> DataFrame:
    """h1, h2, doc, row, start, alone of every window of every stretch."""

    def run(batches):
        for batch in batches:
            for _, doc, row, start, alone, body in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(body, np.uint8)
                one, two = Prefixes(data).windows(least), Prefixes(data, _OTHER).windows(least)
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array([doc] * n, pa.int64()), pa.array(np.full(n, row)), pa.array(np.arange(start, start + n, dtype=np.int32)), pa.array([alone] * n, pa.bool_())],
                    names=["h1", "h2", "doc", "row", "start", "alone"])

    return texts.mapInArrow(run, "h1 long, h2 long, doc long, row long, start int, alone boolean")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, row, body: a row is told by its doc_id and a hash of its text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"), text_bytes().alias("body")).select("doc", F.xxhash64("body").alias("row"), "body")


def repeated_spans(docs: DataFrame, least: int = LEAST, keep: str = "none") -> tuple[DataFrame, DataFrame]:
    """The rows (doc, row, body) of docs and spans (doc, row, start, stop) of repeated bytes, not merged.

    keep = "none" takes every copy, "first" leaves the first one in the order of (doc_id, text hash,
    position), nulls first. Rows equal in id and text are told apart only as copies of one another.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = _keyed(docs)
    runs = stored(_runs(rows, least))
    firsts = [F.min(_place()).alias("first")] if keep == "first" else []
    anchors = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("stretch").alias("low"), F.max("stretch").alias("high"), *firsts).filter("n > 1")
    anchors = stored(anchors.select("anchor", "n", (F.col("low") != F.col("high")).alias("differ"), *(["first"] if firsts else [])))
    marked = stored(join_spread(runs, anchors, ["anchor"]).drop("n"))
    drop_stored(runs)
    drop_stored(anchors)

    differing = marked.filter("differ")
    by_stretch = stored(differing.groupBy("anchor", "stretch").agg(F.count("*").alias("n"), F.min(_place()).alias("place")))
    crowds = by_stretch.groupBy("anchor").agg(F.count("*").alias("stretches"))
    picked = stored(join_spread(by_stretch, crowds, ["anchor"], "stretches").select("anchor", "stretch", (F.col("n") == 1).alias("alone"), (F.col("stretches") > CROWD).alias("crowded"), "n", "place", "place.*"))
    drop_stored(by_stretch)

    stop = (F.col("start") + F.col("windows") - 1 + least).alias("stop")
    alike, copied = marked.filter("NOT differ"), join_spread(differing, picked.filter("NOT alone").select("anchor", "stretch", "n", "place"), ["anchor", "stretch"])
    if keep == "first":
        alike, copied = alike.filter(~_place().eqNullSafe(F.col("first"))), copied.filter(~_place().eqNullSafe(F.col("place")))
    found = alike.select("doc", "row", "start", stop).unionByName(copied.select("doc", "row", "start", stop))

    def stretches(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("doc", "row").agg(F.collect_list(F.struct("anchor", "start", "windows", "alone")).alias("spans"))
        # a left join, so that the exchange of the texts is the one of remove_repeats
        joined = rows.join(wanted, rows["doc"].eqNullSafe(wanted["doc"]) & (rows["row"] == wanted["row"]), "left").select(rows["doc"], rows["row"], "body", "spans")
        each = joined.select("doc", "row", "body", F.explode("spans").alias("s"))
        return each.select("s.anchor", "doc", "row", "s.start", "s.alone", F.expr(f"substring(body, s.start + 1, s.windows + {least - 1})").alias("body"))

    # repeated rows would give their stretches twice over
    texts = stretches(picked.filter("NOT crowded")).dropDuplicates(["anchor", "doc", "row", "start"])
    found = found.unionByName(_blocks(texts.repartition("anchor").sortWithinPartitions("anchor"), least, keep))
    if not picked.filter("crowded").isEmpty():
        windows = _hashed_windows(stretches(picked.filter("crowded")).dropDuplicates(["anchor", "doc", "row", "start"]), least)
        place = F.struct("doc", "row", "start")
        classes = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
        again = windows.join(classes, ["h1", "h2"]).filter(F.col("alone") if keep == "none" else ~place.eqNullSafe(F.col("first")))
        found = found.unionByName(again.select("doc", "row", "start", (F.col("start") + least).alias("stop")))
    return rows, found


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, least: int = LEAST, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), removed (spans) for every row of docs.

    Texts are UTF-8 bytes, a null one is empty; matches never cross texts; a text shorter than
    `least` keeps all. Texts are read whole, a slice of SLICE bytes at a time when they are hashed; of a very
    long one the list of its spans is in one row, at most one for every `least` / 2 bytes. Spans are maximal:
    ones that touch are one. An empty table gives no rows; further columns are not read, whatever their names.
    """
    rows, spans = repeated_spans(docs, least, keep)
    by_row = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = rows.join(by_row, rows["doc"].eqNullSafe(by_row["doc"]) & (rows["row"] == by_row["row"]), "left").select(rows["doc"], "body", "spans")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
        ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def run(batches):
        for batch in batches:
            out = []
            for doc, body, spans in zip(*batch.columns):
                body, cuts = body.as_py(), _merged(spans.as_py())
                edges = [0, *(x for cut in cuts for x in cut), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])) if cuts else body
                out.append((doc.as_py(), len(body), len(body) - len(kept), len(cuts), kept, [{"start": a, "stop": b} for a, b in cuts]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<start:int,stop:int>>")


def removal_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 with every copy removed."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], least: int = LEAST) -> list[list[tuple[int, int]]]:
    """Maximal removed spans of each text, by counting every window; for small fixtures."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - least + 1):
            w = hashlib.sha256(t[i : i + least]).digest()
            seen[w] = seen.get(w, 0) + 1
    return [_merged([{"start": i, "stop": i + least} for i in range(len(t) - least + 1) if seen[hashlib.sha256(t[i : i + least]).digest()] > 1]) for t in texts]
