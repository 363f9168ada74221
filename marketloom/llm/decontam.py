"""Benchmark items found inside documents by SimHash of item-sized windows.

For an item of L words every window of L words of every text is a candidate place. Three
steps, of which the first and the last lose no window that is similar enough, while the radius
of 20 bits loses 1.6e-4 to 3.3e-4 of those at 0.8 (the binomial at a mean distance of 9.2 to 9.7):

1. A window that reaches the similarity shares a known number of its shingles with the
   benchmark. Positions whose shingle is in the benchmark are marked in one vectorised pass;
   windows with fewer marks are passed over.
2. The SimHash of the others is looked up in an index of the items' fingerprints: 64 bits
   in (radius + 1) blocks, of which one at least is equal for any fingerprint in the radius.
3. The pairs within the radius are held to the exact weighted similarity of their shingle
   bags: sum of the lesser weights over sum of the greater, a shingle's weight being how often
   it occurs.

Texts are scanned where they are; the benchmark goes to every task in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import fresh, small_batches, text_bytes
from marketloom.llm.rolling import runs_of_words, word_hashes

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20
#: The radius that leaves out no fingerprint: every window that has enough marked shingles is held to the exact similarity, so nothing is lost.
EXACT = 64
#: Bytes of benchmark text sent to the tasks at a time; a larger benchmark takes more passes.
BLOCK_BYTES = 8 << 20


def simhash(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    bits = np.unpackbits(np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def window_simhashes(hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The SimHash of `width` consecutive hashes from each of the starts."""
    low, high = starts.min(), starts.max() + width
    bits = np.unpackbits(np.ascontiguousarray(hashes[low:high], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    votes = sums[starts - low + width] - sums[starts - low]
    return np.packbits(votes * 2 > width, axis=1, bitorder="little").view("<u8").reshape(-1)


class HammingIndex:
    """Fingerprints by the value of each of (radius + 1) blocks of their 64 bits."""

    def __init__(self, fingerprints: list[int], radius: int):
        self.fingerprints, self.radius = fingerprints, radius
        cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
        self.blocks = [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]
        self.tables = [defaultdict(list) for _ in self.blocks]
        for i, x in enumerate(fingerprints):
            for table, (shift, mask) in zip(self.tables, self.blocks):
                table[x >> shift & mask].append(i)

    def within(self, x: int) -> list[tuple[int, int]]:
        """(number, distance) of every fingerprint within the radius of x."""
        seen = set()
        for table, (shift, mask) in zip(self.tables, self.blocks):
            seen.update(table.get(x >> shift & mask, ()))
        found = ((i, (self.fingerprints[i] ^ x).bit_count()) for i in seen)
        return [(i, d) for i, d in found if d <= self.radius]


def shared_weight(a: Counter, b: Counter) -> float:
    """Sum of lesser weights over sum of greater; 1 for two empty bags."""
    low = sum((a & b).values())
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 1.0


class Benchmark:
    """Items grouped by their number of words, with shingle bags, fingerprints and an index."""

    def __init__(self, items: list[tuple[int, bytes]], similarity: float, radius: int):
        self.similarity = similarity
        data = np.frombuffer(b"".join(t for _, t in items), np.uint8)
        starts = np.concatenate(([0], np.cumsum([len(t) for _, t in items])))[:-1].astype(np.int64)
        hashes, first = word_hashes(data, starts)
        groups = defaultdict(list)
        for k, (item, _) in enumerate(items):
            words = hashes[first[k] : first[k + 1]]
            if len(words):
                width = min(SHINGLE, len(words))
                groups[(width, len(words) - width + 1)].append((item, runs_of_words(words, width)))
        self.groups = {}
        for key, members in groups.items():
            bags = [Counter(h.tolist()) for _, h in members]
            self.groups[key] = ([item for item, _ in members], bags, HammingIndex([simhash(h) for _, h in members], radius))
        self.marks = {w: np.unique(np.concatenate([h for (v, _), m in groups.items() if v == w for _, h in m])) for w in {k[0] for k in groups}}
        self.sieves = {}
        for w, known in self.marks.items():
            sieve = np.zeros(1 << 20, bool)
            sieve[(known >> np.uint64(44)).astype(np.int64)] = True
            self.sieves[w] = sieve

    def in_text(self, hashes: np.ndarray, marked: np.ndarray, width: int):
        """(item, first word, similarity, distance) of each window of a text that is similar to an item of
        this shingle width. hashes: the text's shingle hashes; marked: which are in the benchmark."""
        sums = np.concatenate(([0], np.cumsum(marked)))
        for (w, n), (items, bags, index) in self.groups.items():
            if w != width or not len(hashes):
                continue
            m = min(n, len(hashes))  # a text shorter than the item is one window
            need = math.ceil(self.similarity * (m + n) / (1 + self.similarity) - 1e-9)
            starts = np.flatnonzero(sums[m:] - sums[:-m] >= need)
            for at in range(0, len(starts), 4096):
                part = starts[at : at + 4096]
                for start, x in zip(part.tolist(), window_simhashes(hashes, part, m).tolist()):
                    near = index.within(x)
                    if near:
                        bag = Counter(hashes[start : start + m].tolist())
                        for i, distance in near:
                            alike = shared_weight(bag, bags[i])
                            if alike >= self.similarity - 1e-12:
                                yield items[i], start, alike, distance


def matches_of(texts: pa.Array, bench: Benchmark) -> dict[int, dict[int, tuple]]:
    """For each text (by its number in the batch) that holds items: item -> first word, similarity, distance."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    hashes, first = word_hashes(data, offsets[:-1] - offsets[0])
    found: dict[int, dict[int, tuple]] = defaultdict(dict)
    for width in bench.marks:
        runs = runs_of_words(hashes, width)
        if not len(runs):
            continue
        maybe = np.flatnonzero(bench.sieves[width][(runs >> np.uint64(44)).astype(np.int64)])
        hits = maybe[np.isin(runs[maybe], bench.marks[width])]
        for k in np.unique(np.searchsorted(first, hits, "right") - 1).tolist():
            a, b = first[k], first[k + 1] - width + 1
            if b <= a:  # the run begins in this text and ends in the next
                continue
            own = hits[np.searchsorted(hits, a) : np.searchsorted(hits, b)]
            marked = np.zeros(b - a, bool)
            marked[own - a] = True
            best = found[k]
            for item, start, alike, distance in bench.in_text(runs[a:b], marked, width):
                if item not in best or (-alike, start) < (-best[item][1], best[item][0]):
                    best[item] = (start, alike, distance)
    return {k: best for k, best in found.items() if best}


def _scan(docs: DataFrame, items: list[tuple[int, bytes]], similarity: float, radius: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_BYTES and one item

    def run(batches):
        bench = Benchmark(sent.value, similarity, radius)
        for batch in batches:
            rows = [(batch.column(0)[k].as_py(), item, *x) for k, best in matches_of(batch.column(1), bench).items() for item, x in sorted(best.items())]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()))],
                    names=["doc_id", "item_id", "first_word", "similarity", "distance"])

    return docs.mapInArrow(run, "doc_id long, item_id long, first_word long, similarity double, distance int")


def _without(docs: DataFrame, items: list[tuple[int, bytes]], similarity: float, radius: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        bench = Benchmark(sent.value, similarity, radius)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[list(matches_of(batch.column(batch.num_columns - 1), bench))] = False
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(keep))

    return docs.withColumn(fresh(docs, "_body"), text_bytes()).mapInArrow(run, docs.schema)


def _item_blocks(benchmark: DataFrame):
    """The benchmark's items in lists of about BLOCK_BYTES, one list at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("text")).filter("item_id IS NOT NULL AND length(text) > 0").distinct()
    blocks = (items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_BYTES + 1
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        yield [(r["item_id"], bytes(r["text"])) for r in part.orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, first_word, similarity, distance: each text and item that it holds.

    One row for each row of docs and item with a window at `similarity` or above: the most
    similar window, the first of equals. radius = EXACT loses no window, at more exact checks. Words are letters, digits and all characters beyond
    ASCII, A to Z in lower case; shingles are of five words, or of all words of a shorter item.
    Items without a word, and null texts, match nothing; items of equal text are all named; a
    null item_id is left out. Empty tables give no rows; further columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return reduce(DataFrame.unionByName, [_scan(rows, items, similarity, radius) for items in _item_blocks(benchmark)])


def drop_leaked(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """docs, all columns kept, without the rows that hold a benchmark item; in place, without a shuffle. Null and very long texts, ties and repeated
    rows as in find_leaks; radius = EXACT loses no window."""
    small_batches(docs.sparkSession)
    for items in _item_blocks(benchmark):
        docs = _without(docs, items, similarity, radius)
    return docs
