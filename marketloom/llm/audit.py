"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

A conversation's turns are edited (Keep, Rerole, Delete, Insert) until the initials of their roles read `(s?(ua)+)?`, at
the least cost, and of equally cheap edits by the ASCII-least audit, the string of the edits' initials. Of a role language with four states
(nothing yet, s, u, a) a state and an edit give the next state, so an audit alone says what comes out, and two audits that use the same turns
and end in the same state at the same cost are never one the beginning of the other: the least audit so far stays the least.

Audits are persistent: a node is a parent, an edit, a rolling hash and the ancestors 1, 2, 4, ... steps back, so that states share their
beginnings. Equal costs are settled at the first difference of two audits, which a search by common prefix finds in the ancestors; equal hashes are
then held to the edits themselves.

Turns lie in one global order, dealt by ranges, so that a conversation of any length is cut into chunks of bounded size. A chunk is folded
for each state it may be entered in; what a conversation of several chunks needs is, for each entry and exit, the cost and the place of its audit
among the exits of that entry: first the chunks of a task's range, then the ranges of a conversation, are composed by the same program over nodes.
Then each chunk is repaired by itself, and only the digest of a conversation, which is one of all its text in order, streams through one task.
"""

from __future__ import annotations

import hashlib
from functools import cmp_to_key

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import small_batches, stored

#: Most turns of a chunk, and most characters, but for a single longer turn.
CHUNK_TURNS, CHUNK_CHARS = 512, 4 << 20
#: Rows and characters that a task holds before it hands them on.
OUT_ROWS, OUT_CHARS = 512, 4 << 20
BLANKS = " \t\n\v\f\r"
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
#: States: nothing yet, after s, after u, after a. Where a kept initial leads, where user or assistant leads, and what an end there still lacks.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)
ENDING = ("", "II", "I", "")
ROLE = {2: "user", 3: "assistant"}
STATES = range(4)
MODULUS, BASE = (1 << 61) - 1, 0x9E3779B97F4A7C15 % ((1 << 61) - 1)

#: A node: its depth, the hash of the edits up to it, its edit, its ancestors 1, 2, 4, ... steps back.
ROOT = (0, 0, "", ())


def child(parent: tuple, edit) -> tuple:
    ups = [parent]
    while len(ups[-1][3]) >= len(ups):
        ups.append(ups[-1][3][len(ups) - 1])
    return parent[0] + 1, (parent[1] * BASE + (ord(edit) if isinstance(edit, str) else edit + 1)) % MODULUS, edit, tuple(ups)


def lift(node: tuple, depth: int) -> tuple:
    """The ancestor at a depth."""
    while node[0] > depth:
        node = node[3][min((node[0] - depth).bit_length(), len(node[3])) - 1]
    return node


def edits(node: tuple) -> list:
    out = []
    while node[0]:
        out.append(node[2])
        node = node[3][0]
    return out[::-1]


def _same(x: tuple, y: tuple) -> bool:
    """Whether two nodes of one depth spell the same edits, looked at one by one back to where they meet."""
    while x is not y:
        if x[2] != y[2]:
            return False
        x, y = x[3][0], y[3][0]
    return True


def parting(x: tuple, y: tuple) -> tuple[tuple, tuple] | None:
    """The first nodes in which two audits differ; None if one begins with the other."""
    depth = min(x[0], y[0])
    a, b = lift(x, depth), lift(y, depth)
    if a is b or a[1] == b[1] and _same(a, b):
        return None
    if a[1] != b[1]:
        p, q = a, b
        for k in range(len(p[3]) - 1, -1, -1):
            if k < len(p[3]) and p[3][k][1] != q[3][k][1]:
                p, q = p[3][k], q[3][k]
        if _same(p[3][0], q[3][0]) and p[2] != q[2]:
            return p, q
    k = next(i for i, (s, t) in enumerate(zip(edits(a), edits(b)), 1) if s != t)  # hashes that collide
    return lift(a, k), lift(b, k)


def _less(x: tuple, y: tuple) -> bool:
    found = parting(x, y)
    return x[0] < y[0] if found is None else found[0][2] < found[1][2]


def _offer(cells: list, state: int, cost: int, parent: tuple, edit, less) -> None:
    """Takes an edit into a cell if it is cheaper there, or as cheap and less."""
    old = cells[state]
    if old is None or cost < old[0]:
        cells[state] = (cost, child(parent, edit))
    elif cost == old[0]:
        node = child(parent, edit)
        if less(node, old[1]):
            cells[state] = (cost, node)


def fold(turns: list[tuple], entry: int) -> list:
    """Cheapest cost and least audit node by state after turns (initial, forced, cut_off, copies), entered in a state; inserts stand before the turn they precede.

    copies further equal turns follow a turn at once. They must be deleted, and before any insert (D is less than I), so they only add
    to the cost; expanded() writes them.
    """
    cells: list = [None] * 4
    cells[entry] = (0, ROOT)
    for initial, forced, cut_off, copies in turns:
        for state in (0, 1, 3, 2):  # what 2 gets from the others it hands on to 3
            if cells[state] is not None:
                _offer(cells, NEXT[state], cells[state][0] + INSERT, cells[state][1], "I", _less)
        new: list = [None] * 4
        more = DELETE * copies
        for state in STATES:
            if cells[state] is None:
                continue
            cost, node = cells[state]
            cost += more
            _offer(new, state, cost + DELETE, node, "D", _less)
            if not forced:
                kept = KEPT[state].get(initial)
                if kept is not None:
                    _offer(new, kept, cost + cut_off, node, "K", _less)
                _offer(new, NEXT[state], cost + REROLE + cut_off, node, "R", _less)
        cells = new
    return cells


def compose(pieces: list[tuple], entry: int) -> tuple[list, list]:
    """Cells after pieces (costs, places) of a conversation, an edit being the state a piece is left in, and the place of each cell's audit among them."""
    def less(x, y):
        found = parting(x, y)
        if found is None:
            return x[0] < y[0]
        before = found[0][3][0]
        places, at = pieces[before[0]][1], 4 * (before[2] if before[0] else entry)
        return places[at + found[0][2]] < places[at + found[1][2]]

    cells: list = [None] * 4
    cells[entry] = (0, ROOT)
    for costs, _ in pieces:
        new: list = [None] * 4
        for state in STATES:
            if cells[state] is not None:
                for out in STATES:
                    cost = costs[4 * state + out]
                    if cost is not None:
                        _offer(new, out, cells[state][0] + cost, cells[state][1], out, less)
        cells = new
    order = sorted((s for s in STATES if cells[s] is not None), key=cmp_to_key(lambda s, t: -1 if less(cells[s][1], cells[t][1]) else 1))
    return cells, [order.index(s) if s in order else None for s in STATES]


def ended(costs: list, places: list) -> tuple[int, int]:
    """Exit and whole cost of a conversation, by costs and places of the exits of its entry."""
    cost, _, out = min((costs[s] + INSERT * len(ENDING[s]), places[s], s) for s in STATES if costs[s] is not None)
    return out, cost


def expanded(audit: str, copies: list[int]) -> str:
    """An audit with the deletes of the copies that follow each turn."""
    if not any(copies):
        return audit
    out, turn = [], 0
    for edit in audit:
        out.append(edit)
        if edit != "I" and turn < len(copies):
            out.append("D" * copies[turn])
            turn += 1
    return "".join(out)


def repaired(audit: str, entry: int, roles: list[str], texts: list[str]) -> list[str]:
    """`role:text` of what an audit leaves of turns."""
    state, turn, out = entry, 0, []
    for edit in audit:
        if edit in "RI":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:{texts[turn] if edit == 'R' else ''}")
        elif edit == "K":
            state = KEPT[state][roles[turn][:1]]
            out.append(f"{roles[turn]}:{texts[turn]}")
        turn += edit != "I"
    return out


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of conversation rows, damaged by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties
    its text, 2 takes its `[.!?]`, 3 has it twice, 4 makes it the user's. A null is one space, but turn and conv_id keep theirs beside the hash."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(way == 1, "").when(way == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return rows.filter(way != 0).select("conv_id", "turn", F.when(way == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"), F.when(way == 3, 2).otherwise(1).alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text, copies with their fault: columns blank, later (role and text were seen earlier) and cut_off,
    and more, how many equal rows follow. Rows of one conversation, turn, role and text become one: they lie side by side in the order of turn, role and text."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.withColumns({"seen": F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), "at": F.struct(F.col("turn").isNotNull().alias("has"), "turn"), "blank": body == "",
                             "cut_off": ~F.substring(body, -1, 1).isin(".", "!", "?")})
    again = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("seen").alias("_seen")).agg(F.min("at").alias("_first"), F.count("*").alias("_times")).filter("_times > 1")
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("seen") == F.col("_seen")), "left")
    later = F.coalesce(F.col("at") > F.col("_first"), F.lit(False)) & ~F.col("blank")
    return rows.select("conv_id", "turn", "role", "text", (F.col("copies") - 1).alias("more"), "blank", later.alias("later"), (F.col("cut_off") & ~F.col("blank") & ~later).alias("cut_off"))


def chunked(faulty: DataFrame) -> DataFrame:
    """Chunks of conversations in order (part, seq): what they cost and their audits by entry and exit (4 x 4), their turns, and what is illegal in them."""
    kind = faulty.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, part int, seq long, costs array<long>, places array<int>, audits array<string>, roles array<string>, texts array<string>, more array<long>, "
              "first_initial string, last_initial string, illegal long")

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        conv, turns, size, entries, began = None, [], 0, STATES, False
        held, weight, arrow = [], 0, None

        def chunk() -> tuple:
            costs, places, audits = [None] * 16, [None] * 16, [None] * 16
            short = [(r[:1], forced, cut, n) for r, _, n, forced, cut in turns]
            for e in entries:
                cells = fold(short, e)
                spelt = {s: "".join(edits(cells[s][1])) for s in STATES if cells[s] is not None}
                for place, s in enumerate(sorted(spelt, key=spelt.get)):
                    costs[4 * e + s], places[4 * e + s], audits[4 * e + s] = cells[s][0], place, spelt[s]
            illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(short, short[1:])) + sum(x[3] for x in short)
            return (conv, part, seq, costs, places, audits, [t[0] for t in turns], [t[1] for t in turns], [t[2] for t in turns], short[0][0], short[-1][0], illegal)

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

        for batch in batches:
            arrow = arrow or pa.schema([("conv_id", batch.schema.field(0).type), ("part", pa.int32()), ("seq", pa.int64()), ("costs", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
                                        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("more", pa.list_(pa.int64())), ("first_initial", pa.string()), ("last_initial", pa.string()), ("illegal", pa.int64())])
            for i, role, text, more, forced, cut in zip(*(c.to_pylist() for c in batch.columns)):
                other = not began or i != conv
                if turns and (other or len(turns) >= CHUNK_TURNS or size + len(text) > CHUNK_CHARS):
                    held.append(chunk())
                    weight += size
                    seq, turns, size, entries = seq + 1, [], 0, STATES
                    if len(held) >= OUT_ROWS or weight >= OUT_CHARS:
                        yield handed()
                        held, weight = [], 0
                if other and began:
                    entries = (0,)  # it begins here; the first of a range may go on from the range before
                conv, began = i, True
                turns.append((role, "" if forced else text, more, forced, int(cut)))
                size += len(text)
        if turns:
            held.append(chunk())
            yield handed()

    keys = ["conv_id", "turn", "role", "text"]
    ordered = faulty.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select("conv_id", "role", "text", "more", F.expr("blank OR later"), "cut_off").mapInArrow(run, schema)


def _laid_out(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of conversations of several chunks: (conv_id, part, seq, entry, exit, ending) by chunk, and (conv_id, cost, illegal) by conversation."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    listed = lambda x: [None if v is None or v != v else int(v) for v in x]
    crossing = lambda f: sum(a + b not in ("su", "ua", "au") for a, b in zip(f["last_initial"], f["first_initial"].iloc[1:]))

    def ranges(frame: pd.DataFrame) -> pd.DataFrame:
        """The chunks of a conversation in one range as one piece."""
        frame = frame.sort_values("seq")
        found = [(listed(c), listed(p)) for c, p in zip(frame["costs"], frame["places"])]
        costs, places, exits = [None] * 16, [None] * 16, [None] * 16
        for e in STATES:
            if any(c is not None for c in found[0][0][4 * e : 4 * e + 4]):
                cells, order = compose(found, e)
                for s in STATES:
                    if cells[s] is not None:
                        costs[4 * e + s], places[4 * e + s], exits[4 * e + s] = cells[s][0], order[s], "".join(map(str, edits(cells[s][1])))
        return pd.DataFrame([(frame["conv_id"].iloc[0], frame["part"].iloc[0], frame["seq"].iloc[0], costs, places, exits, frame["first_initial"].iloc[0], frame["last_initial"].iloc[-1], int(frame["illegal"].sum()) + crossing(frame))],
                            columns=["conv_id", "part", "seq", "costs", "places", "exits", "first_initial", "last_initial", "illegal"])

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        """The ranges of a conversation, at most one row a task of the order: the state each is entered and left in."""
        frame = frame.sort_values("part")
        cells, order = compose([(listed(c), listed(p)) for c, p in zip(frame["costs"], frame["places"])], 0)
        last, cost = ended([c[0] if c else None for c in cells], order)
        exits = edits(cells[last][1])
        entries = [0, *exits[:-1]]
        return pd.DataFrame({"conv_id": frame["conv_id"], "part": frame["part"], "seq": frame["seq"], "entry": entries, "path": [x[4 * e + s] for x, e, s in zip(frame["exits"], entries, exits)],
                             "ending": [""] * (len(exits) - 1) + [ENDING[last]], "cost": cost, "illegal": int(frame["illegal"].sum()) + crossing(frame)})

    grouped = pieces.groupBy("conv_id", "part").applyInPandas(ranges, f"conv_id {kind}, part int, seq long, costs array<long>, places array<int>, exits array<string>, first_initial string, last_initial string, illegal long")
    paths = stored(grouped.groupBy("conv_id").applyInPandas(whole, f"conv_id {kind}, part int, seq long, entry int, path string, ending string, cost long, illegal long"))
    step = paths.select("part", "entry", "path", "ending", "seq", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("k"))
    chosen = step.select("part", (F.col("seq") + F.col("k")).alias("seq"), F.when(F.col("k") == 0, F.col("entry")).otherwise(F.expr("cast(substring(path, k, 1) AS int)")).alias("entry"), F.expr("cast(substring(path, k + 1, 1) AS int)").alias("exit"),
                         F.when(F.col("k") == F.length("path") - 1, F.col("ending")).otherwise("").alias("ending"))
    return chosen, paths.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("illegal").alias("illegal"))


def _repair(chunks: DataFrame) -> DataFrame:
    """conv_id, part, seq, cost, illegal, audit, repaired and kept (turns in it) of chunks; without a choice (entry is null) a chunk is a whole conversation."""
    kind = chunks.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = []
            for costs, places, audits, roles, texts, more, entry, out, ending in zip(*(c.to_pylist() for c in batch.columns[4:])):
                cost = None
                if entry is None:
                    out, cost = ended(costs[:4], places[:4])
                    entry, ending = 0, ENDING[out]
                audit = audits[4 * entry + out] + ending
                lines = repaired(audit, entry, roles, texts)
                found.append((cost, expanded(audit, more), "\n".join(lines), len(lines)))
            cost, audit, text, kept = zip(*found)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cost, pa.int64()), batch.column(3), pa.array(audit, pa.string()), pa.array(text, pa.string()), pa.array(kept, pa.int64())],
                                             names=["conv_id", "part", "seq", "cost", "illegal", "audit", "repaired", "kept"])

    columns = ["conv_id", "part", "seq", "illegal", "costs", "places", "audits", "roles", "texts", "more", "entry", "exit", "ending"]
    return chunks.select(*columns).filter(F.size("roles") > 0).mapInArrow(run, f"conv_id {kind}, part int, seq long, cost long, illegal long, audit string, repaired string, kept long")


def _in_order(pieces: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 of conversations of several chunks: their texts stream through the digest one after the other."""
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, digest, audit, began, any_text = None, None, [], False, False
        for batch in batches:
            done = []
            for i, more, text, kept in zip(*(c.to_pylist() for c in batch.columns)):
                if not began or i != conv:
                    if began:
                        done.append((conv, "".join(audit), digest.hexdigest()))
                    conv, digest, audit, began, any_text = i, hashlib.sha256(), [], True, False
                audit.append(more)
                if kept:
                    digest.update((("\n" if any_text else "") + text).encode())
                    any_text = True
            if done:
                yield _rows(done, batch.schema.field(0).type)
        if began:
            yield _rows([(conv, "".join(audit), digest.hexdigest())], batch.schema.field(0).type)

    def _rows(done, type_of):
        a, b, c = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(a, type_of), pa.array(b, pa.string()), pa.array(c, pa.string())], names=["conv_id", "audit", "repaired_sha256"])

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").select("conv_id", "audit", "repaired", "kept").mapInArrow(run, f"conv_id {kind}, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repairs rows conv_id, turn, role, text and copies (how often a row stands there): the judged rows, the repaired pieces (conv_id, part, seq,
    audit, repaired, kept, in the order of part and seq), and of each conversation cost, illegal, audit and repaired_sha256.

    Order: turn, nulls first, then role, then text. Repeated rows are duplicates of the first. A null conv_id is a conversation of its own. Roles and texts
    must not be null. Very long conversations are cut into chunks, a very long text is a chunk of its own.
    """
    small_batches(rows.sparkSession)
    faulty = stored(judged(rows))
    chunks = stored(chunked(faulty))
    short = chunks.select("conv_id", "part", "seq", "costs", "places", "first_initial", "last_initial", "illegal")
    many = chunks.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_n")).filter("_n > 1")
    chosen, sums = _laid_out(short.join(many, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi"))
    alone = chunks.join(chosen, ["part", "seq"], "left_anti").withColumns({"entry": F.lit(None).cast("int"), "exit": F.lit(None).cast("int"), "ending": F.lit(None).cast("string")})
    pieces = _repair(alone), _repair(chunks.join(chosen, ["part", "seq"]))
    ones = pieces[0].select("conv_id", "cost", "illegal", "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
    others = _in_order(pieces[1]).withColumnRenamed("conv_id", "_conv").join(sums, F.col("_conv").eqNullSafe(F.col("conv_id"))).select("conv_id", "cost", "illegal", "audit", "repaired_sha256")
    return faulty, pieces[0].unionByName(pieces[1]), ones.unionByName(others)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damages the conversations and repairs them: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every one.

    Nulls in role and text are one space; a null turn comes first and is no gap; a null conv_id is a conversation of its own. Rows of one turn are in
    the order of role and text, repeated rows side by side. A conversation without rows after the damage has zeros, an empty audit and the digest of an empty
    text. An empty table gives no rows; further columns are not read, whatever their names.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    faulty, _, outcomes = repair(damage(rows))
    copies = F.col("more") + 1
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    facts = faulty.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("later"), copies).otherwise(F.col("more"))).alias("duplicate"), F.sum(F.col("cut_off").cast("long")).alias("truncated"))
    every = rows.select(F.col("conv_id").alias("_id")).distinct()
    joined = every.join(facts, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").join(outcomes, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
