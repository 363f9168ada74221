"""Each operation against a brute-force version, a round trip or held-out accuracy, and on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from marketloom.llm import decontam, licences, mixing, registry, repeats, sharding, simhash, spotsigs, tokens, toxicity, warc
from marketloom.llm.common import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, fp string"


def awkward(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a very long text, clashing columns."""
    long = " ".join(f"word{i % 997} the" for i in range(40_000))
    rows = [(1, None, "en", "s", 0, 0.5, 1, "x"), (2, "", None, None, None, None, None, None), (2, "", None, None, None, None, None, None), (None, "null id", "en", "s", 1, 0.0, 0, ""),
            (3, " \t\n", "en", "s", 3, 0.0, 0, ""), (4, long, "de", "s", len(long), 0.0, 0, ""), (5, long + " tail", "de", "s", 1, 0.0, 0, ""), (6, "a", "fr", "s", 1, 0.0, 0, ""),
            (6, "a b", "fr", "s", 1, 0.0, 0, ""), (7, "é漢🙂   x", "es", "s", 1, 0.0, 0, "")]
    return spark.createDataFrame(rows, DOCS)


def nothing(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 1 — WARC


def test_warc_round_trip(spark):
    big = "z\r\nWARC/1.1\r\n\r\n" * 3000
    rows = [(5, "http://a/\r\nb c", "x"), (3, None, "x"), (9, "u", None), (10, "u", ""), (11, "u", big), (12, "u", "\r\n"), (13, "u", "\r\n\r\n"), (None, "u", "only"), (14, "u", "é漢🙂"), (15, "u", "\n\r"), (15, "u", "\n\r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for chunk in (7, 1000, 1 << 20):
        got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages, chunk_bytes=chunk).collect()}
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(first.get(h or "", i), i)
        want = set()
        for i, _, h in rows:
            data = (h or "").encode()
            owner = first.get(h or "", None)
            want.add((i, len(data), warc.base32(hashlib.sha1(data).digest()), "response" if owner in (i, None) else "revisit", None if owner in (i, None) else owner))
        assert got == want, chunk
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_chunks_carry_digests(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abcdefghij" * 10)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), chunk_bytes=30)
    rows = sorted(warc.read_archives(spark, str(tmp_path / "w")).collect(), key=lambda r: r.chunk)
    assert [r.chunk_bytes for r in rows] == [30, 30, 30, 10] and [r.last for r in rows] == [False] * 3 + [True]
    assert rows[1].digest_so_far == warc.base32(hashlib.sha1(("abcdefghij" * 6).encode()).digest())


def test_warc_awkward(spark):
    """Columns of clashing names, a payload of many chunks, one payload on most rows, repeated rows."""
    rows = [(i % 40, "u", "popular" if i % 3 else "x" * (i * 50), 1, "response", "d", i) for i in range(120)] + [(7, "u", None, 1, "r", "d", 0)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, chunk int, record_type string, payload_digest string, row int").repartition(5)
    got = warc.round_trip(pages, chunk_bytes=64).collect()
    first = {}
    for i, _, h, *_ in rows:
        first[h or ""] = min(first.get(h or "", i), i)
    want = Counter((i, len(h or ""), warc.base32(hashlib.sha1((h or "").encode()).digest()), None if first[h or ""] == i else first[h or ""]) for i, _, h, *_ in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == want
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)


def test_warc_damage_is_seen():
    reader = warc.Reader()
    with pytest.raises(ValueError):
        reader.line(b"not a record")


# 2 — licences


def test_licences(spark):
    mit = licences.KNOWN["MIT"]
    shouted = "MIT License\n".replace("MIT License\n", "") + "Copyright (c) 2020 Someone\nCopyright © 2021 Other\nAll rights reserved.\n" + mit.upper().replace("SUBLICENSE", "SUBLICENCE").replace(" ", "  ")
    rows = [(1, mit), (2, shouted), (3, mit + " and more"), (4, None), (5, ""), (6, "released UNDER the mit licence!"), (7, "(c) 1999\n" + licences.KNOWN["ISC"].replace('"', "“"))]
    got = {r.doc_id: r.license_id for r in licences.match_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "MIT-notice", 7: "ISC"}
    assert licences.match_licences(awkward(spark)).count() == 10 and licences.match_licences(nothing(spark)).count() == 0


def test_licences_as_they_are_published(spark):
    """Titles, stars for numbers, other spellings; every text has a digest of its own, and none but its own matches."""
    k = licences.KNOWN
    rows = [("MIT", "MIT License\n\nCopyright (c) 2024 A\n\n" + k["MIT"]), ("MIT", "The MIT License (MIT)\n" + k["MIT"]), ("ISC", "ISC License\nCopyright 1999 B\n" + k["ISC"].replace("and/or distribute", "and distribute")),
            ("BSD-3-Clause", "BSD 3-Clause License\nCopyright (c) 2020, C\nAll rights reserved.\n" + k["BSD-3-Clause"].replace("\n2. ", "\n* ").replace("\n1. ", "\n* ").replace("\n3. ", "\n* ")), ("BSD-2-Clause", k["BSD-2-Clause"]),
            ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n" + k["BSL-1.0"].replace("organization", "organisation")), ("Unlicense", k["Unlicense"].upper()), ("MIT-0", "MIT No Attribution\nCopyright 2020 D\n" + k["MIT-0"]), ("X11", k["X11"]),
            ("Zlib", k["Zlib"]), ("Zlib", "zlib\n" + k["Zlib"]), ("Zlib", "\n\nzlib\n\n" + k["Zlib"]), ("Zlib", "# zlib\n\t// X11:\n" + k["Zlib"]), ("0BSD", k["0BSD"] + "\n * BSD Zero Clause"), ("BSL-1.0", "-- the Boost Software.\n" + k["BSL-1.0"]),
            (None, "MIT License"), (None, k["MIT"][:-10]), (None, k["BSD-3-Clause"].replace("endorse", "praise"))]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, (_, t) in enumerate(rows)], "doc_id long, text string, license_id string, canonical_digest string")
    got = {r.doc_id: r.license_id for r in licences.match_licences(docs).collect()}
    assert got == {i: name for i, (name, _) in enumerate(rows)}
    digests = [r.license_digest for r in licences.known_digests(spark).collect()]
    assert len(set(digests)) == len(digests) == len(licences.known_texts())


def test_licences_sql_agrees(spark):
    """The SQL and the operator on published texts, whatever the number of copyright lines."""
    import duckdb

    texts = [("Copyright (c) 2003 A\n" * n) + body + ("\r\n(c) 1999\n" * (n % 3)) for n in (0, 1, 4, 7) for _, body in licences.known_texts()] + ["", "MIT License\nx", "ISC\n\nall rights reserved.\n a  B", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = docs.toPandas()
    con = duckdb.connect()
    con.register("documents", frame)
    want = {tuple(r) for r in con.execute(licences.oracle()).fetchall()}
    assert {(r.doc_id, r.canonical_digest, r.license_id) for r in licences.match_licences(docs).select("doc_id", "canonical_digest", "license_id").collect()} == want
    assert sum(r[2] is not None for r in want) >= 4 * len(licences.known_texts())


def test_licences_under_many_copyright_lines(spark):
    lines = ["Copyright (c) 2003 Holder {}", "All rights reserved.", "# (c) 1999 by {}", "copyright by {}"]
    runs = [*range(1, 11), 5000]
    rows = [(n, "".join(lines[i * k % 4].format(i) + "\n" for i in range(n)) + licences.KNOWN["MIT"]) for n in runs for k in (0, 1)]
    rows += [(-n, licences.KNOWN["ISC"] + "\r\n" + "\r\n".join([lines[0]] * n)) for n in runs]
    got = licences.match_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(r.license_id == ("MIT" if r.doc_id > 0 else "ISC") for r in got)


# 3 — sharding


def test_shards(spark):
    docs = documents(spark)
    rows = sorted(sharding.shard_documents(docs).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in docs.select("doc_id").collect())
    sizes = defaultdict(int)
    slots = defaultdict(list)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in rows:
        assert r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)
    assert all(s == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(awkward(spark)).count() == 10 and sharding.shard_documents(nothing(spark)).count() == 0


# 4 — toxicity


def test_toxicity_held_out(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows, marks = [], []
    for i in range(1500):
        sentences = [" ".join(rnd.choice(words) for _ in range(8)) for _ in range(rnd.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            k = rnd.randrange(len(sentences))
            sentences[k] += " " + rnd.choice(["zorkan", "zorkel", "Zorkoq!"])
        rows.append((i, ". ".join(sentences)))
        marks.append((i, 0, int(toxic)))
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), {i: t for i, _, t in marks}
    out = toxicity.toxicity_scores(docs, labels(spark, marks)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.98
    texts = dict(rows)
    assert all("zork" in texts[r.doc_id][r.worst_start : r.worst_end].lower() for r in held if r.predicted)


def test_toxicity_score_by_hand(spark):
    """Every score is the noisy-or of its sentences' logistic scores, from the model's weights."""
    import math
    import re

    docs = documents(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.weights and all(w > 0 for w in model.weights.values())

    def pieces(word):
        marked = "<" + re.sub(r"[\W\d_]+", "", word).lower() + ">"
        return {marked} | {marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1)} if len(marked) > 2 else set()

    def by_hand(text):
        sentences = [s for s in re.split(r"[.!?\n]", text) if s] or [""]
        scores = [1 / (1 + math.exp(-(model.bias + sum(model.weights.get(x, 0.0) for w in s.split() for x in pieces(w))))) for s in sentences]
        return 1 - math.prod(1 - p for p in scores)

    for r in toxicity.score(docs, model).collect():
        assert abs(r.score - by_hand(r.text or "")) < 1e-9 and r.predicted == (r.score >= 0.7)


def test_toxicity_awkward(spark):
    out = toxicity.toxicity_scores(awkward(spark), labels(spark)).collect()
    assert len(out) == 10 and all(0 <= r.score < 0.7 for r in out)
    assert toxicity.toxicity_scores(nothing(spark), labels(spark)).count() == 0
    kept = toxicity.reject_toxic(spark, awkward(spark), labels(spark, [(1, 0, 1), (2, None, None), (None, 1, 0)]))
    assert kept.columns == awkward(spark).columns and kept.count() == 10


# 5 — repeats


def test_factor_arrays():
    """Longest previous factors cut at 4, and the nearest occurrences, against all pairs of windows."""
    rnd = random.Random(4)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(4, 30))) for _ in range(8)]
    windows = [p[i : i + 4] for p in parts for i in range(len(p) - 3)]
    factors, previous, following = repeats.factor_arrays([repeats.np.frombuffer(p, repeats.np.uint8) for p in parts], 4)
    for i, w in enumerate(windows):
        before, after = [j for j in range(i) if windows[j] == w], [j for j in range(i + 1, len(windows)) if windows[j] == w]
        assert (factors[i], previous[i], following[i]) == (4 if before else 0, before[-1] if before else -1, after[0] if after else -1)


def test_repeats_of_a_crowded_anchor(spark):
    """More differing stretches around one passage than CROWD, without touching it; and a passage that most rows share."""
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    passage = word(230)
    texts = [word(120) + passage[rnd.randrange(20) :] + word(120) for _ in range(2300)] + [passage] * 40
    raw = [t.encode() for t in texts]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.removal_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: (sum(b - a for a, b in cuts), len(cuts)) for i, cuts in enumerate(repeats.brute_force(raw))}


@pytest.mark.parametrize("crowd", [2048, 0])
def test_repeats_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rnd = random.Random(11)
    base = ["".join(rnd.choice("ab é") for _ in range(rnd.randint(150, 700))) for _ in range(12)]
    texts = base + [base[0][100:] + "x" + base[1], base[2] + base[2], "a" * 450, base[3], base[3], None, "", base[4][:210] + base[5][50:], "a" * 199, "a" * 200] + [base[6][i : i + 260] for i in range(0, 300, 23)]
    rows = [(i if i != 14 else None, t) for i, t in enumerate(texts)]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removal_report(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    raw = [(t or "").encode() for t in texts]
    want = []
    for (i, _), t, cuts in zip(rows, raw, repeats.brute_force(raw)):
        kept, at = b"", 0
        for a, b in cuts:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        want.append((-1 if i is None else i, len(t), len(t) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_repeats_keep_first(spark):
    rnd = random.Random(3)
    body = "".join(rnd.choice("abcdef") for _ in range(300))
    docs = spark.createDataFrame([(1, body), (2, body), (3, "x" + body + "y"), (4, body[50:])], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs, keep="first").collect()}
    assert got[1] == 0 and got[2] == 300 and got[3] == 300 and got[4] == 250


def test_repeats_awkward(spark):
    out = {(r.doc_id, r.n_bytes): r.n_removed for r in repeats.removal_report(awkward(spark)).collect()}
    assert len(out) == 9 and out[(1, 0)] == 0 and out[(2, 0)] == 0
    assert repeats.removal_report(nothing(spark)).count() == 0


# 6 — SpotSigs


def test_spotsigs(spark):
    docs = spark.createDataFrame([(1, "The quick brown of fox jumps a lazy dog sleeps"), (2, "the QUICK, brown of fox jumps; a lazy dog sleeps"), (3, "nothing common here"), (4, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in spotsigs.edited_likeness(docs).collect()}
    assert rows[1].fingerprint == rows[2].fingerprint and len(rows[1].fingerprint.split(",")) == 3
    assert rows[2].near_next == 1.0 and rows[3].near_next == 0.0 and rows[4].n_chars == 0
    text = "the QUICK, brown of fox jumps; a lazy dog sleeps"
    edited = text[: len(text) - len(text) // 2] + docs.filter("doc_id = 1").first().text[: len(text) // 2]
    assert rows[2].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    groups = {r.doc_id: r.group_id for r in spotsigs.near_duplicates(docs).collect()}
    assert groups[1] == groups[2] == 1 and groups[3] == 3


def test_spotsigs_next(spark):
    """The neighbour by descending id over many ranges, ties, nulls, one row."""
    rnd = random.Random(2)
    rows = [(rnd.randrange(60), str(k)) for k in range(80)] + [(None, "n1"), (None, "n2")]
    got = {(r.doc_id, r.text): r.next_text for r in spotsigs.with_next(spark.createDataFrame(rows, "doc_id long, text string"), ["text"]).collect()}
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1]))
    assert got == {r: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert spotsigs.with_next(one, ["text"]).first().next_text == "abcd"
    assert spotsigs.edited_likeness(awkward(spark)).count() == 10 and spotsigs.edited_likeness(nothing(spark)).count() == 0


# 7 — SimHash


def brute_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(prints):
    parent = {f: f for f in prints.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = list(parent)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    best = {}
    for d, f in prints.items():
        best[find(f)] = min(best.get(find(f), d), d)
    return {d: best[find(f)] for d, f in prints.items()}


def test_simhash_groups(spark):
    rows = documents(spark).collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    want = brute_components(prints)
    got = simhash.near_groups(documents(spark)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{f:016x}", want[d]) for d, f in prints.items()}


@pytest.mark.parametrize("crowd", [512, 3])
def test_simhash_links_crowded_cells(spark, crowd):
    rnd = random.Random(4)
    values = set()
    for _ in range(6):
        x = rnd.getrandbits(64)
        values.update(x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(60))
    prints = {i: v for i, v in enumerate(sorted(values))}
    fps = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in prints.values()], "fp long")
    found = {r.node: r.component for r in components(simhash.hamming_links(fps, 2, crowd=crowd)).collect()}
    want = brute_components(prints)
    label = {i: found.get(v - 2**64 if v >= 2**63 else v, (v - 2**64 if v >= 2**63 else v)) for i, v in prints.items()}
    assert len(set(zip(want.values(), label.values()))) == len(set(want.values())) == len(set(label.values()))


def test_simhash_awkward(spark):
    out = simhash.near_groups(awkward(spark)).collect()
    assert len(out) == 10 and {r.component_id for r in out if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_groups(nothing(spark)).count() == 0
    kept = simhash.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 4), (False, 6), (False, 6), (False, 7), (True, 0)]
    assert simhash.one_of_each(nothing(spark)).count() == 0


def test_near_copies_by_similarity(spark):
    rows = {r.doc_id: set(zip(*[simhash.words_of((r.text or "").encode())[k:] for k in range(5)])) for r in documents(spark).collect()}
    kept = {r.doc_id for r in simhash.one_of_each(documents(spark)).collect()}
    ids = sorted(rows)
    alike = {(a, b): len(rows[a] & rows[b]) / max(1, len(rows[a] | rows[b])) for i, a in enumerate(ids) for b in ids[i + 1 :] if rows[a] & rows[b]}
    assert not [p for p, j in alike.items() if j >= 0.87 and p[0] in kept and p[1] in kept]
    gone = [d for d in ids if d not in kept]
    assert all(any(j >= 0.7 and d in p for p, j in alike.items()) for d in gone if rows[d])


def similarity(a, b):
    a, b = (set(zip(*[t.split()[k:] for k in range(5)])) for t in (a, b))
    return len(a & b) / len(a | b)


def pairs_alike(rnd, lo, hi, pairs, words=204):
    """Texts 2k and 2k + 1 of a similarity in [lo, hi): a shared head, tails of their own; other pairs share nothing."""
    rows = []
    for k in range(pairs):
        for cut in range(words, 0, -1):
            head, tails = [f"h{k}x{i}" for i in range(cut)], [[f"{s}{k}x{i}" for i in range(words - cut)] for s in "ab"]
            one, two = (" ".join(head + tail) for tail in tails)
            if similarity(one, two) < hi:
                break
        assert lo <= similarity(one, two)
        rows += [(2 * k, one), (2 * k + 1, two)]
    rnd.shuffle(rows)
    return rows


def test_near_copies_at_the_least_similarity(spark):
    rows = pairs_alike(random.Random(3), 0.8, 0.812, 400)
    assert simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).count() <= 400 + 6
    assert not [p for p in alike_kept(spark) if p[2] >= 0.8]


def alike_kept(spark):
    """(a, b, similarity) of the given documents that are kept."""
    rows = {r.doc_id: set(zip(*[simhash.words_of((r.text or "").encode())[k:] for k in range(5)])) for r in documents(spark).collect()}
    kept = sorted(r.doc_id for r in simhash.one_of_each(documents(spark)).collect())
    return [(a, b, len(rows[a] & rows[b]) / len(rows[a] | rows[b])) for i, a in enumerate(kept) for b in kept[i + 1 :] if rows[a] & rows[b]]


def test_near_copies_only_from_the_least_similarity(spark):
    rows = pairs_alike(random.Random(5), 0.78, 0.8, 400)
    assert simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).count() == 800
    sets = {r.doc_id: set(zip(*[simhash.words_of((r.text or "").encode())[k:] for k in range(5)])) for r in documents(spark).collect()}
    kept = {r.doc_id for r in simhash.one_of_each(documents(spark)).collect()}
    assert all(any(e != d and len(sets[d] & sets[e]) >= 0.8 * len(sets[d] | sets[e]) for e in sets) for d in sets if d not in kept and sets[d])


def test_near_copies_of_one_template(spark):
    rnd = random.Random(12)
    base = [f"w{rnd.randrange(3000)}" for _ in range(400)]
    rows = []
    for i in range(240):
        words = list(base)
        for at in rnd.sample(range(400), rnd.choice((3, 6, 10, 14, 20))):
            words[at] = f"x{rnd.randrange(40)}" if i % 2 else f"y{i}_{at}"
        rows.append((i, " ".join(words[: rnd.choice((400, 400, 380))])))
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows]
    alike = [(a, b) for a in range(240) for b in range(a) if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))]
    top = list(range(240))
    for _ in range(240):
        for a, b in alike:
            top[a] = top[b] = min(top[a], top[b])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc: r.group for r in simhash.near_copies(docs).collect()}
    names = {}
    assert [names.setdefault(found[i], i) for i in range(240)] == top and 1 < len(set(top)) < 240
    number = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    whole = spark.createDataFrame([(i, [number[x] for x in s]) for i, s in enumerate(sets)], "node long, shingles array<long>")
    ids = spark.createDataFrame([(i, i) for i in range(240)], "node long, group long")
    early = simhash._rarest(whole)
    pairs = {(r.a, r.b) for r in simhash._meeting(early, ids, 0, simhash.ROUNDS[-1]).collect()}
    assert pairs.issuperset(alike) and len(pairs) < 240 * 239 // 4
    rounds = [{(r.a, r.b) for r in simhash._meeting(early, ids, low, high).collect()} for low, high in zip((0, *simhash.ROUNDS), simhash.ROUNDS)]
    assert sum(map(len, rounds)) == len(pairs) and set.union(*rounds) == pairs


def test_components(spark):
    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 300) if i % 10] + [(rnd.randrange(300), 1000) for _ in range(3)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = list(range(1001))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    touched = {x for a, b in edges for x in (a, b) if a != b}
    assert got == {x: find(x) for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 8 — token counts


def test_token_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = tokens.load_vocabulary()
    reference = Tokenizer(models.Unigram(vocabulary, 0, True))
    reference.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.BLANK, prepend_scheme="always", split=True)
    count = lambda t: len(reference.encode(t, add_special_tokens=False).ids)
    rows = {r.doc_id: r.text for r in documents(spark).collect()}
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(documents(spark), vocabulary).collect()}
    assert got == {d: count(t or "") for d, t in rows.items()}
    counter = tokens.Counter(vocabulary)
    rnd = random.Random(1)
    for _ in range(2000):
        text = "".join(rnd.choice(" ▁abcthe\n\t漢é<s>0x</s>🙂 ing") for _ in range(rnd.randint(0, 25)))
        assert counter.text(text)[0] == count(text), text
    out = {r.doc_id: r.n_tokens for r in tokens.count_tokens(awkward(spark), vocabulary).collect()}
    assert out[1] == out[2] == 0 and tokens.count_tokens(nothing(spark), vocabulary).count() == 0


def test_token_counts_of_an_unbroken_text():
    """A text without a blank, longer than the steps that are held, against the whole program."""
    vocabulary = tokens.load_vocabulary()
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcthe漢é🙂ingxyz") for _ in range(3 * tokens.KEPT_STEPS))
    held = tokens.Counter(vocabulary).text(text)
    whole = tokens.KEPT_STEPS
    try:
        tokens.KEPT_STEPS = 10**9
        assert held == tokens.Counter(vocabulary).text(text)
    finally:
        tokens.KEPT_STEPS = whole


def test_token_ties():
    vocabulary = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0)]
    from tokenizers import Tokenizer, models, pre_tokenizers

    reference = Tokenizer(models.Unigram(vocabulary, 0, False))
    reference.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = tokens.Counter(vocabulary)
    for text in ("ab", "abab", "a ab b", "ba", "aab"):
        assert counter.text(text)[0] == len(reference.encode(text).ids), text


# 9 — mixing


def test_mixing_meets_targets(spark):
    docs = documents(spark)
    labelled = mixing.labelled_languages(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    weights = {"de": 0.25, "en": 0.25, "es": 0.25, "fr": 0.25}
    for least in (0.0, 1.0):
        rows = mixing.mix(docs, labelled, weights, least).collect()
        sums = [sum(r.rate * r.tokens * r.posterior[k] for r in rows) for k in range(4)]
        assert max(sums) - min(sums) <= 1e-4 * sum(sums) and min(r.rate for r in rows) >= least
        assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in rows)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(r.domain == truth[r.doc_id] for r in rows) / len(rows) > 0.95


def test_mixing_is_the_least_squares_optimum(spark):
    """The conditions of the optimum of sum tokens (rate - 1)^2 under the targets and rate >= 0, held densely: free rates are 1 + posterior . c
    for one c, those at the bound would be below it."""
    import numpy as np

    docs = documents(spark)
    labelled = mixing.labelled_languages(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for weights in ({"de": 0.4, "en": 0.1, "es": 0.2, "fr": 0.3}, {"de": 0.01, "en": 0.9, "es": 0.05, "fr": 0.04}):
        rows = [r for r in mixing.mix(docs, labelled, weights, most_miss=0.05).collect() if r.tokens]
        p, rate, t = np.array([r.posterior for r in rows]), np.array([r.rate for r in rows]), np.array([float(r.tokens) for r in rows])
        free = rate > 1e-9
        c = np.linalg.lstsq(p[free], rate[free] - 1, rcond=None)[0]
        assert np.abs(1 + p[free] @ c - rate[free]).max() < 1e-6 and (1 + p[~free] @ c <= 1e-6).all()
        # no step along the null space of the targets lowers the objective: rates from a dense solve of the free rows agree
        a, w = (p * t[:, None]).T[:, free], t[free]
        goal = a @ rate[free]
        dense = 1 + (a.T @ np.linalg.lstsq((a / w) @ a.T, goal - a @ np.ones(free.sum()), rcond=None)[0]) / w
        assert np.abs(dense - rate[free]).max() < 1e-6


def test_mixing_keeps_rare_domains(spark):
    """A hundred domains, of which one has two rows among thousands: each has its target."""
    rows = [(i, f"d{i % 99:02} word{i % 99} more{i % 99}", f"d{i % 99:02}") for i in range(3960)] + [(5000, "rare one", "rare"), (5001, "rare two", "rare")]
    docs = spark.createDataFrame([r[:2] + ("old", 9) for r in rows], "doc_id long, text string, domain string, tokens int")
    labelled = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, domain string")
    out = mixing.fit_domains(docs, labelled)
    assert len(out.names) == 100 and "rare" in out.names
    got = {r.doc_id: r.domain for r in mixing.memberships(docs, out).select("doc_id", "posterior").collect() for r in [type("R", (), {"doc_id": r.doc_id, "domain": out.names[max(range(100), key=lambda k: r.posterior[k])]})]}
    assert got == {r[0]: r[2] for r in rows}


def test_mixing_bound_is_active(spark):
    """A target that wants nothing of one domain: its rates stop at zero."""
    docs = documents(spark)
    labelled = mixing.labelled_languages(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    with pytest.raises(ValueError, match="missed"):
        mixing.mix(docs, labelled, {"en": 1.0})
    rows = mixing.mix(docs, labelled, {"en": 1.0}, most_miss=None).collect()
    assert min(r.rate for r in rows) == 0.0
    en = sum(r.rate * r.tokens * r.posterior[1] for r in rows)
    assert en / sum(r.rate * r.tokens for r in rows) > 0.97


def test_mixing_awkward(spark):
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert mixing.mix(awkward(spark), none).count() == 10
    some = spark.createDataFrame([(4, "x"), (4, "w"), (6, None), (None, "z")], "doc_id long, domain string")
    assert mixing.mix(awkward(spark), some).count() == 10 and mixing.mix(nothing(spark), none).count() == 0
    repeated = mixing.repeat_rows(mixing.mix(awkward(spark), none, least=1.0), awkward(spark).columns)
    assert repeated.columns == awkward(spark).columns and repeated.count() >= 10


# 10 — decontamination


def brute_leaks(docs, items, similarity=0.8):
    import re

    words = lambda t: re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").encode().lower())
    bag = lambda w, k: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    found = {}
    for d, t in docs:
        w = words(t)
        for i, x in items:
            v = words(x)
            if not v or i is None:
                continue
            k = min(5, len(v))
            want, n = bag(v, k), len(v)
            for s in range(max(1, len(w) - n + 1)):
                have = bag(w[s : s + n], k)
                low = sum((have & want).values())
                j = low / (sum(have.values()) + sum(want.values()) - low)
                if j >= similarity and j > found.get((d, i), (0, 0))[0]:
                    found[(d, i)] = (j, s)
    return {(d, i, s, round(j, 9)) for (d, i), (j, s) in found.items()}


def test_leaks_brute_force(spark):
    rnd = random.Random(9)
    vocab = ["w%d" % i for i in range(300)]
    line = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(line(rnd.choice([3, 12, 25, 40])))) for i in range(12)] + [(50, None), (51, ""), (52, "--"), (None, "w1 w2 w3 w4 w5 w6")]
    items.append((60, items[4][1]))
    docs = []
    for d in range(40):
        w = line(rnd.randint(0, 60))
        if d % 3 == 0:
            x = items[d % 12][1].split()
            if d % 2:
                x[rnd.randrange(len(x))] = "changed"
            at = rnd.randrange(len(w) + 1)
            w = w[:at] + x + w[at:]
        docs.append((d, ("Ü, ".join(w) if d % 5 == 4 else " ".join(w).upper())))
    docs += [(100, None), (101, ""), (102, items[2][1])]
    got = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), radius=64 - 1)
    got = {(r.doc_id, r.item_id, r.first_word, round(r.similarity, 9)) for r in got.collect()}
    assert got == brute_leaks(docs, items) and len(got) >= 8
    real = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in real.collect()} == {x[:2] for x in got}


def test_leaks_blocks_and_awkward(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = decontam.find_leaks(documents(spark), bench)
    want = {tuple(r) for r in whole.collect()}
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 3000)
    assert {tuple(r) for r in decontam.find_leaks(documents(spark), bench).collect()} == want and want
    kept = decontam.drop_leaked(documents(spark), bench)
    assert kept.count() == documents(spark).count() - len({r[0] for r in want}) and kept.columns == documents(spark).columns
    assert decontam.drop_leaked(awkward(spark), bench).count() == 10 and decontam.find_leaks(nothing(spark), bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(documents(spark), empty).count() == 0


def test_leaks_of_all_documents(spark):
    """The default radius against brute force on all documents of sf0.01: none is lost."""
    big = SF.replace("sf0.001", "sf0.01")
    docs, bench = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.find_leaks(docs, bench).collect()}
    want = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.find_leaks(docs, bench, radius=63).collect()}
    assert got == want and want
    items = [(r.item_id, r.text) for r in bench.collect()]
    texts = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 1500]
    small = {d for d, _ in texts}
    assert {(d, i, j) for d, i, _, j in brute_leaks(texts, items)} == {(d, i, j) for (d, i), j in got.items() if d in small}


def test_leaks_at_the_exact_radius(spark):
    """EXACT takes every fingerprint, its complement too; on these documents the default radius loses nothing against it."""
    index = decontam.HammingIndex([0, 2**64 - 1, 5], decontam.EXACT)
    assert sorted(i for i, _ in index.within(0)) == [0, 1, 2]
    docs, bench = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    key = lambda frame: sorted((r.doc_id, r.item_id, r.first_word, round(r.similarity, 9)) for r in frame.collect())
    assert key(decontam.find_leaks(docs, bench)) == key(decontam.find_leaks(docs, bench, radius=decontam.EXACT))


def test_hamming_index():
    rnd = random.Random(6)
    held = [rnd.getrandbits(64) for _ in range(300)]
    index = decontam.HammingIndex(held, 6)
    for x in held[:20]:
        y = x ^ sum(1 << b for b in rnd.sample(range(64), 6))
        assert dict(index.within(y)) == {i: (v ^ y).bit_count() for i, v in enumerate(held) if (v ^ y).bit_count() <= 6}


# registry and pipeline


def test_registry_names():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in registry.queries()}


def test_pipeline(spark):
    """The whole run equals its stages, and its decisions agree with brute force on each stage's input."""
    import corpus_pipeline

    docs, kept = documents(spark), []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SF)
        if name != "sharding":
            assert docs.columns == documents(spark).columns
            docs = docs.cache()
        kept.append((name, before, {r.doc_id for r in docs.select("doc_id").collect()}))
    stages = {n: (a, b) for n, a, b in kept}
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    a, b = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert a - b == {x[0] for x in brute_leaks([(d, texts[d]) for d in sorted(a)], items)}
    assert stages["mixing"][0] == stages["mixing"][1] == stages["sharding"][1]
    whole = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in whole.collect()} == stages["sharding"][1]


def test_stages_keep_columns_of_any_name(spark):
    """Columns that are called as a stage's helpers and outputs are: all stages keep them, with their values."""
    docs = documents(spark)
    names = ["_scored_text", "_words", "_unit", "_copy", "_body", "_doc", "_row", "doc", "row", "group", "node", "license_id", "canonical_digest", "component_id", "fingerprint", "law", "slot", "domain_"]
    with_clashes = docs.withColumns({n: F.concat(F.lit(f"{n}:"), "doc_id") for n in names})
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")

    def stages(frame):
        yield "toxicity", toxicity.reject_toxic(spark, frame, marks)
        yield "copies", simhash.one_of_each(frame)
        yield "leaks", decontam.drop_leaked(frame, bench)
        yield "mixing", mixing.repeat_rows(mixing.mix(frame, mixing.labelled_languages(frame, marks), least=1.0), frame.columns)

    plain = {name: sorted(r.doc_id for r in out.collect()) for name, out in stages(docs)}
    for name, out in stages(with_clashes):
        assert out.columns == with_clashes.columns, name
        rows = out.collect()
        assert sorted(r.doc_id for r in rows) == plain[name], name
        assert all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names), name
