"""SimHash fingerprints and the groups of texts whose fingerprints nearly agree.

A fingerprint of any length is a row of 64-bit words, each a majority vote over the hashed
word shingles. Two ways lead from fingerprints to groups:

near_groups    exact for a small Hamming radius. A fingerprint is embedded as the bit counts
               of its two-bit segments; the Manhattan distance of two embeddings never
               exceeds the Hamming distance. The segments are dealt into blocks, and two
               embeddings within the radius r agree in at least (blocks - r) whole blocks,
               so the grid has one cell for each such choice of blocks and their counts. Pairs
               that share a cell are held to the Manhattan bound, then to the exact
               Hamming distance. A cell with very many fingerprints is not paired up: two
               fingerprints within two bits have a common neighbour one flip away, and
               that neighbour links all who have it.
near_copies    for a set similarity of 0.8: the same grid first, over words of a long fingerprint.
               It reaches the closest copies only, as further down no choice of blocks is
               selective; what it leaves apart meets in bands of least shingle hashes. Long
               fingerprints thin out the pairs, and the shingle sets decide, see there.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import components, drop_stored, fresh, join_spread, small_batches, stored, text_bytes

SEED = 42
#: Shingles that are voted on at a time: bounds the memory a very long text takes.
SLICE = 1 << 15


def shingle_hashes(words: list[bytes], width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of `width` words joined by a space, repeats included; of the whole
    sequence if it is shorter; none for no words."""
    if not words:
        return np.empty(0, np.uint64)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64, len(starts))


def words_of(text: bytes) -> list[bytes]:
    """Words after lower-casing A to Z: runs of anything but space and the controls 9 to 13."""
    return text.lower().split()


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th 64-bit word's hashes, from the first's: a multiply-xor mix, the first unchanged."""
    if k == 0:
        return hashes
    x = hashes + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint_words(hashes: np.ndarray, words: int = 1) -> np.ndarray:
    """`words` 64-bit words: a bit is 1 if it is set in over half of the hashes; zero for none."""
    out = np.zeros(words, np.uint64)
    if not len(hashes):
        return out
    for k in range(words):
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), SLICE):
            part = np.ascontiguousarray(_mixed(hashes[at : at + SLICE], k), "<u8").view(np.uint8).reshape(-1, 8)
            # shingle counts a byte can hold are summed as bytes, which is far faster than wider sums
            bits = np.unpackbits(part, axis=1, bitorder="little")
            whole = len(bits) // 255 * 255
            if whole:
                votes += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            votes += bits[whole:].sum(axis=0, dtype=np.uint8)
        out[k] = np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3, words: int = 1) -> DataFrame:
    """id_column, fp (array of `words` longs) for every row; texts are read whole, a null is empty."""
    small_batches(docs.sparkSession)
    schema = pa.schema([(id_column, pa.int64()), ("fp", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            found = [fingerprint_words(shingle_hashes(words_of(x.as_py()), width), words).view(np.int64).tolist() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, schema.field(1).type)], schema=schema)

    return docs.select(F.col(id_column).cast("long").alias(id_column), text_bytes(text).alias("_text")).mapInArrow(run, f"`{id_column}` long, fp array<long>")


def _two_bit_counts(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, packed where the segments are, in unary: 00, 01 or 11.
    Two such vectors differ in as many bits as their counts differ by in all."""
    odd = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _blocks(blocks: int) -> list[int]:
    """Masks that deal the 32 segments into contiguous blocks, as signed longs."""
    cuts = [32 * i // blocks for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def _manhattan(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def grid_cells(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """fp, counts, choice, cell: a row for each choice of (blocks - radius) blocks."""
    counted = fps.select("fp", _two_bit_counts(F.col("fp")).alias("counts"))
    masks = _blocks(blocks)
    signed = lambda m: m - 2**64 if m >= 2**63 else m
    kept = [signed(sum(masks[i] % 2**64 for i in pick)) for pick in combinations(range(blocks), blocks - radius)]
    cells = F.array(*[F.struct(F.lit(k).alias("choice"), F.col("counts").bitwiseAND(F.lit(m)).alias("cell")) for k, m in enumerate(kept)])
    return counted.select("fp", "counts", F.inline(cells))


def hamming_links(fps: DataFrame, radius: int = 2, blocks: int = 0, crowd: int = 512) -> DataFrame:
    """Links (a, b) between distinct 64-bit fingerprints such that all fingerprints within
    `radius` bits (0 to 2) are connected, and none are connected by a longer step.

    fps: a column fp, distinct. A cell with more than `crowd` fingerprints is linked through
    common one-bit neighbours, exactly; the others by an equi-join on the cell.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the radius is 0, 1 or 2: crowded cells are linked through neighbours one flip away")
    cells = grid_cells(fps, radius, blocks or radius + 2)
    sizes = cells.groupBy("choice", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = stored(sizes)
    light = cells.join(sizes.filter(F.col("n") <= crowd).drop("n"), ["choice", "cell"])
    a, b = light.alias("a"), light.alias("b")
    near = (F.col("a.fp") < F.col("b.fp")) & (_manhattan(F.col("a.counts"), F.col("b.counts")) <= radius) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
    pairs = a.join(b, (F.col("a.choice") == F.col("b.choice")) & (F.col("a.cell") == F.col("b.cell")) & near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    if sizes.filter(F.col("n") > crowd).isEmpty() or radius == 0:
        return pairs
    crowded = cells.join(sizes.filter(F.col("n") > crowd).drop("n"), ["choice", "cell"], "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(2**63)) for i in range(64)])
    around = crowded.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    if radius == 2:
        first = around.groupBy("at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
        stars = around.join(first, "at").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    else:
        stars = around.join(crowded.select(F.col("fp").alias("b")), F.col("at") == F.col("b")).filter("fp < b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def near_groups(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id for every row of docs.

    Words are split at the ASCII white space after lower-casing A to Z; a text without words
    has fingerprint zero and is linked like any other. component_id is the smallest doc_id
    reachable through links of at most `radius` bits. Rows with equal fingerprints are one
    node, so a group of equal texts is one row until the last join. A null doc_id keeps its
    row and never names a component, unless no other row is in it (then null). An empty
    table gives no rows; further columns are not read.
    """
    rows = stored(fingerprints(docs, width=width).select("doc_id", F.col("fp")[0].alias("fp")))
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(hamming_links(nodes.select("fp"), radius))
    labels = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    named = labels.join(names, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near copies: sets of five-word shingles, of which COPY_SHARE (of the union, as a fraction) must be common. The cells are
# BANDS groups of BAND_MINS minima; the radius of COPY_WORDS words of 64 bits only spares exact checks, and holds for sets
# of SURE_SIZE shingles or more, as votes of fewer are too coarse.
COPY_WIDTH, COPY_SHARE, BANDS, BAND_MINS = 5, (4, 5), 24, 7
COPY_WORDS, COPY_RADIUS, SURE_SIZE = 16, 200, 64
#: The first words of a fingerprint that go to the grid, one by one, and how many bits of a word may differ there.
GRID_WORDS, GRID_RADIUS = 2, 2
#: Pairs across groups are compared in rounds: a sixteenth of them by hash, then up to a quarter, then all others that
#: are of different groups still.
ROUNDS = (1, 4, 16)
#: Odd factors, each of which puts the shingle hashes in another order.
FACTORS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * BAND_MINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes) -> np.ndarray:
    """The distinct hashes of a text's COPY_WIDTH-word shingles, in order."""
    return np.unique(shingle_hashes(words_of(text), COPY_WIDTH))


def band_cells(shingles: np.ndarray) -> np.ndarray:
    """A 64-bit cell for each band: the hash of the least shingles in BAND_MINS orders. Two sets share
    the cell of a band with a chance of their similarity to the power of BAND_MINS; none for no shingles."""
    if not len(shingles):
        return np.empty(0, np.int64)
    low = np.full(len(FACTORS), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[at : at + 1024, None] * FACTORS).min(axis=0), out=low)
    data, width = low.astype("<u8").tobytes(), 8 * BAND_MINS
    return np.fromiter([xxhash.xxh64_intdigest(data[b * width : (b + 1) * width], b) for b in range(BANDS)], np.uint64, BANDS).view(np.int64)


def grid_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes (node, fp) that the grid finds near: of each of the first GRID_WORDS words of the fingerprint, the nodes of an equal word with the
    least of them, and the least nodes of words within GRID_RADIUS bits, by segment counts, grid, Manhattan bound and Hamming distance (see hamming_links)."""
    found = []
    for k in range(GRID_WORDS):
        worded = nodes.select("node", F.col("fp")[k].alias("fp"))
        least = stored(worded.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n")))
        name = lambda end: least.select(F.col("fp").alias(end), F.col("least").alias(f"{end}node"))  # noqa: E731, B023
        found.append(hamming_links(least.select("fp"), GRID_RADIUS).join(name("a"), "a").join(name("b"), "b").select("anode", "bnode"))
        found.append(join_spread(worded, least.filter("n > 1"), ["fp"]).filter("node <> least").select(F.col("node").alias("anode"), F.col("least").alias("bnode")))
    return reduce(DataFrame.unionByName, found).select(F.greatest("anode", "bnode").alias("a"), F.least("anode", "bnode").alias("b")).distinct()


def _apart(a: str, b: str) -> Column:
    """Hamming distance of two fingerprints."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(COPY_WORDS)), F.lit(0))


def _may_match(a: str, b: str, radius: int) -> Column:
    """Whether the set sizes and fingerprints of a and b leave room for COPY_SHARE of the union to be common."""
    least, whole = COPY_SHARE
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    sizes = (n * whole >= m * least) & (m * whole >= n * least)
    return sizes & ((n < SURE_SIZE) | (m < SURE_SIZE) | (_apart(f"{a}fp", f"{b}fp") <= radius))


def _sets(wanted: DataFrame, nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """node, shingles: the shingle sets of the wanted nodes, made again from the text of each node's first row."""
    def run(batches):
        for batch in batches:
            found = [shingle_set(x.as_py()).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    first = nodes.join(wanted, "node").select("node", F.col("place.doc").alias("_doc"), F.col("place.row").alias("_row"))
    texts = keyed.join(first, keyed["doc"].eqNullSafe(first["_doc"]) & (keyed["row"] == first["_row"])).select("node", "_text")
    # rows of one id and text are one node's, so they may come more than once
    return stored(texts.mapInArrow(run, "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles")))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets have COPY_SHARE of their union in common, exactly."""
    least, whole = COPY_SHARE
    one, two = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return stored(pairs.join(one, "a").join(two, "b").filter(common * (least + whole) >= (F.size("sa") + F.size("sb")) * least).select("a", "b"))


def _rarest(sets: DataFrame) -> DataFrame:
    """node, n, shingle, at: the shingles among which every pair of sets with COPY_SHARE of its union in common meets.

    Each set is put in order from its rarest shingle. Of two similar sets, the first common shingle stands so
    early in both that the shingles from it on still make the overlap needed: among the first (1 - s) n + 1 of the
    larger set and the first (1 - 2s/(1+s)) n + 1 of the smaller, s being the share. Shingles of one set alone
    take up places in the order but are not joined.
    """
    least, whole = COPY_SHARE
    tokens = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    facts = stored(tokens.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"))
    of_node = Window.partitionBy("node")
    shared = join_spread(tokens, facts, ["shingle"], "df").withColumn("alone", F.col("n") - F.count("*").over(of_node))
    placed = shared.withColumn("at", F.col("alone") + F.row_number().over(of_node.orderBy("df", "shingle")))
    early = stored(placed.filter(F.col("at") <= F.expr(f"n - ceil(n * {least} / {whole}) + 1")).select("node", "n", "shingle", "at"))
    drop_stored(facts)
    return early


def _meeting(early: DataFrame, groups: DataFrame, low: int, high: int) -> DataFrame:
    """Distinct pairs (a, b) of nodes of different groups that meet in one of their rarest shingles, early enough for
    the overlap needed, and whose hash modulo the last of ROUNDS is from low to below high."""
    least, whole = COPY_SHARE
    both = least + whole
    named = early.join(groups, "node")
    a, b = (named.select("shingle", *(F.col(c).alias(f"{side}{c}") for c in ("node", "group", "n", "at"))) for side in "ab")
    overlap = 1 + F.least(F.col("an") - F.col("aat"), F.col("bn") - F.col("bat"))
    larger = (F.col("an") > F.col("bn")) | ((F.col("an") == F.col("bn")) & (F.col("anode") > F.col("bnode")))
    sizes = F.col("bn") * whole >= F.col("an") * least
    turn = F.pmod(F.xxhash64(F.greatest("anode", "bnode"), F.least("anode", "bnode")), F.lit(ROUNDS[-1])).between(low, high - 1)
    indexed = b.filter(F.expr(f"bat <= bn - ceil(bn * {2 * least} / {both}) + 1"))
    met = a.join(indexed, "shingle").filter(larger & sizes & turn & (F.col("agroup") != F.col("bgroup")) & (overlap * both >= (F.col("an") + F.col("bn")) * least))
    return stored(met.select(F.greatest("anode", "bnode").alias("a"), F.least("anode", "bnode").alias("b")).distinct())


def _merged(labelled: DataFrame, links: DataFrame) -> DataFrame:
    """labelled (node, group) after the links (a, b) of nodes: linked groups take the least of their names."""
    name = lambda end: labelled.select(F.col("node").alias(end), F.col("group").alias(f"{end}group"))
    edges = links.join(name("a"), "a").join(name("b"), "b").select(F.col("agroup").alias("a"), F.col("bgroup").alias("b"))
    found = components(edges).withColumnRenamed("node", "group")
    return stored(labelled.join(found, "group", "left").select("node", F.coalesce("component", "group").alias("group")))


def near_copies(docs: DataFrame, radius: int = COPY_RADIUS) -> DataFrame:
    """doc, row, group: the rows of docs (by doc_id and a hash of the text) and the group each is in.

    Two texts are near copies if the sets of their five-word shingles have a Jaccard similarity of
    0.8 or more, which is held exactly for every link; groups are what links connect, so two texts of
    one group may be further apart. The closest copies are found by the grid (see grid_pairs) and grouped. Candidates of
    different groups then share a cell: one of 24 bands of 7 least hashes, which
    pairs at a similarity of 0.8 do with a chance of 0.9965, at 0.85 with 0.9999. A 1,024-bit
    fingerprint of the set then spares exact checks of pairs more than `radius` bits apart; at 0.8 the
    expected distance is 155 bits, and 200 is 4 deviations off, so it loses under 1 in 10,000 there.
    In a cell, each set is first compared with the least one, which links up copies by the thousand with
    as few comparisons. Sets in a cell that is still of several groups are compared where they meet in one
    of their rarest shingles, which misses none of the similar pairs there. That is done in rounds over growing
    parts of the pairs, by hash: a set that a round links to a group is not compared with the rest of that
    group any more, and the last round takes every pair of different groups that is left, so the rounds
    change how many pairs are compared but no group. Texts without words have equal, empty sets.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc"), text_bytes().alias("_text")).withColumn("row", F.xxhash64("_text"))
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("fp", longs), ("cells", longs)])

    def run(batches):
        for batch in batches:
            node, n, fp, cells = [], [], [], []
            for x in batch.column(2):
                shingles = shingle_set(x.as_py())
                node.append(xxhash.xxh64_intdigest(shingles.astype("<u8").tobytes(), SEED) - 2**63)
                n.append(len(shingles))
                fp.append(fingerprint_words(shingles, COPY_WORDS).view(np.int64))
                cells.append(band_cells(shingles))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v, f.type) for v, f in zip((node, n, fp, cells), list(schema)[2:]))], schema=schema)

    rows = stored(keyed.select("doc", "row", "_text").mapInArrow(run, "doc long, row long, node long, n int, fp array<long>, cells array<long>"))
    place = F.struct("doc", "row")
    nodes = stored(rows.groupBy("node").agg(F.min(place).alias("place"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("cells").alias("cells")))
    print_of = lambda side: nodes.select(F.col("node").alias(side), F.col("n").alias(f"{side}n"), F.col("fp").alias(f"{side}fp"))
    may_match = lambda pairs: stored(pairs.join(print_of("a"), "a").join(print_of("b"), "b").filter(_may_match("a", "b", radius)).select("a", "b"))

    def linked(tried: DataFrame) -> DataFrame:
        ends = tried.select(F.col("a").alias("node")).unionByName(tried.select(F.col("b").alias("node"))).distinct()
        sets = _sets(ends, nodes, keyed)
        links = _similar(tried, sets)
        drop_stored(sets)
        return links

    alone = nodes.select("node", F.col("node").alias("group"))
    near = _merged(alone, linked(may_match(grid_pairs(nodes))))
    celled = stored(nodes.join(near, "node").select("node", "cells", "group"))
    placed = celled.select("node", "group", F.explode("cells").alias("cell"))
    of_cell = placed.groupBy("cell").agg(F.min(F.struct("node", "group")).alias("first"), F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high"))
    least = stored(of_cell.filter("low <> high").select("cell", "n", F.col("first.node").alias("b"), F.col("first.group").alias("bgroup")))
    tried = may_match(join_spread(placed, least, ["cell"]).filter("group <> bgroup").select(F.col("node").alias("a"), "b").distinct())
    labelled = _merged(near, linked(tried))
    celled = stored(nodes.join(labelled, "node").select("node", "cells", "group"))
    labelled = celled.select("node", "group")
    placed = celled.select("node", "group", F.explode("cells").alias("cell"))
    mixed = stored(placed.groupBy("cell").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("n")).filter("low <> high").select("cell", "n"))
    left = stored(join_spread(placed, mixed, ["cell"]).select("node").distinct())
    sets = _sets(left, nodes, keyed)
    early = _rarest(sets)
    for low, high in zip((0, *ROUNDS), ROUNDS):
        links = _similar(may_match(_meeting(early, labelled, low, high)), sets)
        if not links.isEmpty():
            labelled = _merged(labelled, links)
    drop_stored(early)
    drop_stored(sets)
    return rows.select("doc", "row", "node").join(labelled, "node").select("doc", "row", "group")


def one_of_each(docs: DataFrame, radius: int = COPY_RADIUS) -> DataFrame:
    """docs, all columns kept, with one row of each group of near copies: that of the smallest doc_id
    (nulls last), of equal ids that of the smallest text hash; of rows equal in both, which may differ in other columns, any."""
    grouped = stored(near_copies(docs, radius))
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    first = grouped.groupBy("group").agg(F.min(place).alias("p")).select("p.doc", "p.row")
    doc, row = fresh(docs, "_doc"), fresh(docs, "_row")
    keyed = docs.withColumn(doc, F.col("doc_id").cast("long")).withColumn(row, F.xxhash64(text_bytes()))
    kept = keyed.join(first, keyed[doc].eqNullSafe(first["doc"]) & (keyed[row] == first["row"]), "left_semi")
    if not grouped.groupBy("doc", "row").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([doc, row])
    return kept.select(*docs.columns)
