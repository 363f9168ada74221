"""Conversation repair against the rules written out with plain strings."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from marketloom.llm import audit

SF = "/root/testdata/sf0.01"
CONVERSATIONS = "conv_id long, turn long, role string, text string"
WS = " \t\n\v\f\r"


def brute(rows):
    """Rows (conv_id, turn, role, text) by the rules: {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)}."""
    shown = lambda x: " " if x is None else str(x)
    groups = {}
    for conv, turn, role, text in rows:
        own = groups.setdefault(conv, [])
        way = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        own += [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return {conv: judge(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for conv, own in groups.items()}


def judge(turns):
    counts, seen, rows = [0, 0, 0], set(), []
    for _, role, text in turns:
        body = text.rstrip(WS)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        rows.append((role, text, fault in (0, 1), fault == 2))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits, lines = cheapest(rows)
    return (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def cheapest(rows):
    """Least (cost, audit) by turns used and role initials so far, the initials kept as a state of the pattern."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def take(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def inserts(table):
        for _ in range(4):
            for state, (cost, edits, out) in list(table.items()):
                for to in step[state]:
                    if to in names:
                        take(table, to, (cost + 2, edits + "I", (*out, f"{names[to]}:")))
        return table

    for role, text, forced, cut in rows:
        new = {}
        for state, (cost, edits, out) in inserts(best).items():
            take(new, state, (cost + 3, edits + "D", out))
            if not forced:
                if role[:1] in step[state]:
                    take(new, step[state][role[:1]], (cost + cut, edits + "K", (*out, f"{role}:{text}")))
                for to in step[state]:
                    if to in names:
                        take(new, to, (cost + 2 + cut, edits + "R", (*out, f"{names[to]}:{text}")))
        best = new
    return min(x for s, x in inserts(best).items() if s in ("", "a"))


def enumerated(rows):
    """Every sequence of edits with up to two inserts at a place."""
    found = []
    for ops in product("DKR", repeat=len(rows)):
        if any(f and o != "D" or o == "K" and not role for o, (role, _, f, _) in zip(ops, rows)):  # no initial fits nowhere
            continue
        for ins in product(range(3), repeat=len(rows) + 1):
            edits = "".join("I" * n + o for n, o in zip(ins, [*ops, ""]))
            for roles in product("ua", repeat=sum(e in "RI" for e in edits)):
                free, turn, initials, cost = iter(roles), 0, "", 0
                for e in edits:
                    role, _, _, cut = rows[turn] if e != "I" else ("", "", False, 0)
                    initials += {"D": "", "K": role[:1]}.get(e) if e in "DK" else next(free)
                    cost += {"D": 3, "K": 0, "R": 2, "I": 2}[e] + (cut if e in "KR" else 0)
                    turn += e != "I"
                if re.fullmatch("(s?(ua)+)?", initials):
                    found.append((cost, edits))
    return min(found)


def table(spark, rows, schema=CONVERSATIONS):
    return spark.createDataFrame(rows, schema).repartition(3)


def report(frame):
    got = audit.repair_report(frame).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_brute_force_is_the_least_of_all_edits():
    rng = random.Random(1)
    for _ in range(40):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(4))]
        assert cheapest(rows)[:2] == enumerated(rows)


def test_fold_against_strings():
    rng = random.Random(2)
    for n in (1, 2, 5, 30, 300):
        for _ in range(60):
            rows = [(rng.choice(["user", "assistant", "assistant", "system", "tool", "", "urs"]), f"t{i}", rng.random() < 0.2, rng.random() < 0.3) for i in range(n)]
            want = cheapest(rows)
            cells = audit.fold([(r[:1], f, int(c), 0) for r, _, f, c in rows], 0)
            spelt = {s: "".join(audit.edits(c[1])) for s, c in enumerate(cells) if c}
            places = [sorted(spelt.values()).index(spelt[s]) if s in spelt else None for s in audit.STATES]
            out, cost = audit.ended([c[0] if c else None for c in cells], places)
            edits = spelt[out] + audit.ENDING[out]
            assert (cost, edits) == want[:2]
            assert tuple(audit.repaired(edits, 0, [r[0] for r in rows], [r[1] for r in rows])) == want[2]


@pytest.mark.parametrize("modulus", [audit.MODULUS, 3, 1])
def test_parting(monkeypatch, modulus):
    """Also with hashes that collide nearly always: the edits decide."""
    monkeypatch.setattr(audit, "MODULUS", modulus)
    rng = random.Random(3)
    nodes = [audit.ROOT]
    for _ in range(400):
        nodes.append(audit.child(rng.choice(nodes[-30:]), rng.choice("DIKR")))
    for _ in range(3000):
        x, y = rng.choice(nodes), rng.choice(nodes)
        a, b = "".join(audit.edits(x)), "".join(audit.edits(y))
        assert audit._less(x, y) == (a < b)
        found = audit.parting(x, y)
        if found is not None:
            k = found[0][0]
            assert a[: k - 1] == b[: k - 1] and (a[k - 1], b[k - 1]) == (found[0][2], found[1][2])


def test_composition_of_pieces():
    """Pieces cut anywhere, composed twice over, give the cost and the audit of the whole."""
    rng = random.Random(4)
    for n in (1, 3, 12, 60):
        for _ in range(40):
            rows = [(rng.choice(["u", "a", "s", "t"]), rng.random() < 0.2, int(rng.random() < 0.3), rng.choice([0, 0, 2])) for _ in range(n)]
            pieces, spelt, at = [], [], 0
            while at < n:
                size = rng.randrange(1, 6)
                costs, places, audits = [None] * 16, [None] * 16, [None] * 16
                for e in audit.STATES:
                    cells = audit.fold(rows[at : at + size], e)
                    found = {s: "".join(audit.edits(c[1])) for s, c in enumerate(cells) if c}
                    for place, s in enumerate(sorted(found, key=found.get)):
                        costs[4 * e + s], places[4 * e + s], audits[4 * e + s] = cells[s][0], place, found[s]
                pieces.append((costs, places))
                spelt.append(audits)
                at += size
            cells, order = audit.compose(pieces, 0)
            whole = audit.fold(rows, 0)
            for s in audit.STATES:
                assert (cells[s] is None) == (whole[s] is None)
                if whole[s]:
                    exits = audit.edits(cells[s][1])
                    text = "".join(a[4 * e + x] for a, e, x in zip(spelt, [0, *exits], exits))
                    assert (cells[s][0], text) == (whole[s][0], "".join(audit.edits(whole[s][1])))
            texts = {s: "".join(audit.edits(c[1])) for s, c in enumerate(whole) if c}
            assert order == [sorted(texts.values()).index(texts[s]) if s in texts else None for s in audit.STATES]


def test_given_table(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    assert report(frame) == brute([(r.conv_id, r.turn, r.role, r.text) for r in frame.collect()])


def noisy(rng, conv, n):
    texts = ["yes.", "no", "ok!", " ", "", "What?", "fine.\n", "é漢🙂", "\t."]
    return [(conv, None if rng.random() < 0.05 else rng.randrange(max(1, n * 2)), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             None if rng.random() < 0.05 else rng.choice(texts) + (str(rng.randrange(n)) + "." if rng.random() < 0.7 else "")) for _ in range(n)]


@pytest.mark.parametrize("turns", [512, 5])
def test_noisy_conversations(spark, monkeypatch, turns):
    """One conversation with most rows, many small ones, repeated rows, equal turns, nulls; chunks of five turns as well."""
    monkeypatch.setattr(audit, "CHUNK_TURNS", turns)
    rng = random.Random(turns)
    rows = noisy(rng, 1, 700) + [r for c in range(2, 80) for r in noisy(rng, c, rng.randrange(1, 14))] + noisy(rng, None, 30)
    rows += rng.sample(rows, 60) + [(5, 3, "user", "again.")] * 40
    assert report(table(spark, rows)) == brute(rows)


def test_pieces_are_the_repaired_texts(spark, monkeypatch):
    monkeypatch.setattr(audit, "CHUNK_TURNS", 4)
    rng = random.Random(8)
    rows = noisy(rng, 1, 90) + noisy(rng, 2, 3)
    want = brute(rows)
    _, pieces, _ = audit.repair(audit.damage(table(spark, rows)))
    found = sorted(pieces.collect(), key=lambda r: (r.part, r.seq))
    for conv in (1, 2):
        own = [r for r in found if r.conv_id == conv]
        assert "".join(r.audit for r in own) == want[conv][6]
        assert hashlib.sha256("\n".join(r.repaired for r in own if r.kept).encode()).hexdigest() == want[conv][7]


def test_awkward(spark):
    """Dropped and blank conversations, long texts, columns of clashing names, an empty table."""
    rows = [(9, t, "user", "x") for t in range(200) if zlib.crc32(f"9:{t}".encode()) % 20 == 0] + [(10, 1, "user", " \t"), (11, None, None, None), (None, None, None, None), (12, 1, "user", "long " * 400_000 + "."), (12, 2, "assistant", "b.")]
    clashing = [(*r, "a", 1, "c", "d", 2) for r in rows]
    frame = table(spark, clashing, CONVERSATIONS + ", audit string, copies int, seen string, blank string, part int")
    got = report(frame)
    assert got == brute(rows) and got[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert report(spark.createDataFrame([], CONVERSATIONS)) == {}
