"""SentencePiece encoding and decoding of a byte-fallback BPE model, by vectorised merge rounds.

A text is escaped as the library does it (a blank before it, blanks as U+2581) and cut before every run of
blanks: no piece of the model crosses such a cut, so words are merged apart and each distinct word once a task.
All new words of a task lie in flat numpy arrays, one symbol a character. A round looks up the pair of every two
neighbours, takes the least rank of each word by a segmented minimum, merges the leftmost non-overlapping pairs of
that rank in all words at once, and compacts the arrays; it ends when no pair is left. The library merges one
pair at a time, so the pairs of a round are taken together only if none of them makes a pair of equal or better
rank on the way (runs of blanks do); the other words do their round pair by pair.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import small_batches
from marketloom.llm.tokens import BLANK, TOKENIZERS

#: Symbols from here on are characters that are no piece: FOREIGN + code point.
FOREIGN = 1 << 21
SHIFT = 22
NONE = np.int64(1 << 40)
#: Words and ids of words that a task keeps before it starts anew, and words handled at a time.
KEPT_WORDS, KEPT_IDS, STEP = 300_000, 8_000_000, 1 << 17
WORD = re.compile(" +[^ ]*")
#: What the library writes for the unknown id.
UNKNOWN_SURFACE = " ⁇ "


@dataclass
class PieceModel:
    """A model as flat tables: a bounded number of pieces, whatever the corpus."""

    of_char: np.ndarray  # code point -> symbol
    pairs: np.ndarray  # sorted left << SHIFT | right
    made: np.ndarray  # the piece that a pair makes
    rank: np.ndarray  # of that piece; pieces of equal score share it
    byte_id: np.ndarray  # byte -> its piece
    surface: np.ndarray  # the bytes of all pieces, one after the other
    begins: np.ndarray
    sizes: np.ndarray
    kind: np.ndarray  # 0 a piece, 1 a byte, 2 nothing to show
    end_id: int


def load_model(path: str | None = None) -> PieceModel:
    """The tables of a SentencePiece file (the public 32k one by default). Only byte-fallback BPE models without normalisation are taken."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or f"{TOKENIZERS}/piece_bpe_32k.model")
    size = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(size)]
    plain = {t: i for i, t in enumerate(texts) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    if any(BLANK in t.lstrip(BLANK) for t in plain):
        raise ValueError("a piece crosses a blank: texts cannot be cut there")
    scores = sorted({model.get_score(i) for i in plain.values()}, reverse=True)
    rank_of = {s: r for r, s in enumerate(scores)}
    of_char = np.arange(0x110000, dtype=np.int64) + FOREIGN
    for t, i in plain.items():
        if len(t) == 1:
            of_char[ord(t)] = i
    symbol = lambda t: int(of_char[ord(t)]) if len(t) == 1 else plain.get(t)
    found = []
    for t, i in plain.items():
        for cut in range(1, len(t)):
            left, right = symbol(t[:cut]), symbol(t[cut:])
            if left is not None and right is not None:
                found.append((left << SHIFT | right, i, rank_of[model.get_score(i)]))
    pairs, made, rank = (np.array(x, np.int64) for x in zip(*sorted(found)))
    byte_id = np.full(256, -1, np.int64)
    kind, surface = np.zeros(size, np.int8), []
    for i, t in enumerate(texts):
        if model.is_byte(i):
            byte_id[int(t[1:-1], 16)] = i
            kind[i] = 1
            surface.append(bytes([int(t[1:-1], 16)]))
        elif model.is_control(i):
            kind[i] = 2
            surface.append(b"")
        else:
            surface.append((UNKNOWN_SURFACE if model.is_unknown(i) else t.replace(BLANK, " ")).encode())
    if (byte_id < 0).any():
        raise ValueError("the model has no byte fallback")
    sizes = np.array([len(x) for x in surface], np.int64)
    out = PieceModel(of_char, pairs, made, rank, byte_id, np.frombuffer(b"".join(surface), np.uint8), np.cumsum(sizes) - sizes, sizes, kind, model.eos_id())
    for probe in ("", " ", "Ab  cd\nⅠﬁ é ▁x", "   aaaa bbbb    "):
        if Encoder(out).encode(probe).tolist() != model.encode(probe):
            raise ValueError("the model is not a BPE model without normalisation")
    return out


def _gather(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches flat[begin : begin + size], one after the other."""
    total = np.cumsum(sizes)
    if not len(total) or not total[-1]:
        return flat[:0]
    return flat[np.arange(total[-1]) + np.repeat(begins - (total - sizes), sizes)]


class Encoder:
    """Encodes texts; keeps the ids of the words it has met."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.flat, self.begins, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols; NONE where they make no piece."""
        m = self.model
        key = left << SHIFT | right
        at = np.minimum(np.searchsorted(m.pairs, key), len(m.pairs) - 1)
        hit = m.pairs[at] == key
        return np.where(hit, m.rank[at], NONE), m.made[at]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that words (blanks as blanks) come to, and how many each has."""
        m = self.model
        codes = np.frombuffer("".join(words).replace(" ", BLANK).encode("utf-32-le"), np.uint32)
        sym = m.of_char[codes]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)  # of a symbol and the next one
        fresh = np.flatnonzero(word[:-1] == word[1:])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            rank[fresh], made[fresh] = self._pairs(sym[fresh], sym[fresh + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(rank, starts)
            over = np.repeat(least == NONE, lengths)
            if over.any():  # no pair is left in these words
                done.append((word[over], sym[over]))
                sym, word, rank, made = sym[~over], word[~over], rank[~over], made[~over]
                lengths, least = lengths[least != NONE], least[least != NONE]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(least, lengths))
            order = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.r_[True, at[1:] != at[:-1] + 1], order, 0))
            picked = at[(order - run) % 2 == 0]
            slow = self._entangled(sym, word, rank, made, picked)
            if len(slow):
                picked = picked[~np.isin(word[picked], slow)]
            gone = np.zeros(len(sym), bool)
            sym[picked] = made[picked]
            gone[picked + 1] = True
            touched = [picked]
            for w in slow:
                touched.append(self._one_by_one(sym, rank, made, gone, *np.searchsorted(word, [w, w + 1])))
            rank[gone] = NONE
            keep = np.flatnonzero(~gone)
            place = np.cumsum(~gone) - 1
            changed = place[np.concatenate(touched)]
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            fresh = np.unique(np.r_[changed, changed - 1])
            fresh = fresh[fresh >= 0]
            rank[fresh] = NONE
            fresh = fresh[fresh + 1 < len(sym)]
            fresh = fresh[word[fresh] == word[fresh + 1]]
        ends = np.concatenate([x[0] for x in done]) if done else word
        syms = np.concatenate([x[1] for x in done]) if done else sym
        turn = np.argsort(ends, kind="stable")
        return syms[turn], np.bincount(ends, minlength=len(words))

    def _entangled(self, sym, word, rank, made, picked) -> np.ndarray:
        """The words in which a merge of this round makes a pair of equal or better rank beside another merge of it."""
        many = np.r_[False, word[picked][1:] == word[picked][:-1]]
        many = many | np.r_[many[1:], False]
        p = picked[many]
        if not len(p):
            return p
        last, end = np.maximum(p - 1, 0), np.minimum(p + 2, len(sym) - 1)
        joined = np.r_[False, p[1:] == p[:-1] + 2]
        left = np.where(joined, made[np.maximum(p - 2, 0)], sym[last])
        before, _ = self._pairs(left, made[p])
        after, _ = self._pairs(made[p], sym[end])
        before = np.where((p > 0) & (word[last] == word[p]), before, NONE)
        after = np.where((p + 2 < len(sym)) & (word[end] == word[p]), after, NONE)
        return np.unique(word[p[(before <= rank[p]) | (after <= rank[p])]])

    def _one_by_one(self, sym, rank, made, gone, lo: int, hi: int) -> np.ndarray:
        """A round of the word sym[lo:hi], pair by pair: every pair of the least rank or a better one that comes up. Returns what was merged."""
        top = int(rank[lo:hi].min())
        after, before = list(range(1, hi - lo + 1)), list(range(-1, hi - lo - 1))
        now, size = sym[lo:hi].tolist(), hi - lo
        heap = [(top, int(i), now[i], now[i + 1], int(made[lo + i])) for i in np.flatnonzero(rank[lo:hi] == top)]
        heapify(heap)
        live, merged = [True] * size, set()
        while heap:
            _, i, a, b, made_of = heappop(heap)
            j = after[i]
            if not live[i] or j >= size or now[i] != a or now[j] != b:
                continue
            now[i], live[j], after[i] = made_of, False, after[j]
            if after[j] < size:
                before[after[j]] = i
            merged.add(i)
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < size:
                    r, made_of = self._pairs(np.array([now[x]]), np.array([now[y]]))
                    if r[0] <= top:
                        heappush(heap, (int(r[0]), x, now[x], now[y], int(made_of[0])))
        sym[lo:hi] = now
        gone[lo:hi] = ~np.array(live)
        return lo + np.array(sorted(i for i in merged if live[i]), np.int64)

    def _learn(self, words: list[str]) -> None:
        """Adds the ids of new words to the table: symbols are piece ids already, foreign characters become bytes."""
        syms, counts = self.merged(words)
        foreign = syms >= FOREIGN
        if foreign.any():
            codes = (syms[foreign] - FOREIGN).astype(np.uint32)
            raw = np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), np.uint8)
            sizes = np.ones(len(syms), np.int64)
            sizes[foreign] = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
            ids = np.repeat(syms, sizes)
            ids[np.repeat(foreign, sizes)] = self.model.byte_id[raw]
            counts = np.add.reduceat(sizes, np.cumsum(counts) - counts)
        else:
            ids = syms
        self.begins = np.r_[self.begins, len(self.flat) + np.cumsum(counts) - counts]
        self.sizes = np.r_[self.sizes, counts]
        self.flat = np.r_[self.flat, ids.astype(np.int32)]

    def _ids(self, held: list[tuple[int, list[str]]]) -> list[tuple[int, np.ndarray]]:
        """The ids of stretches of words; what is new among all of them is merged at once."""
        if len(self.kept) > KEPT_WORDS or len(self.flat) > KEPT_IDS:
            self._forget()
        kept, known = self.kept, len(self.kept)
        found = [(i, np.array([kept.setdefault(w, len(kept)) for w in words], np.int64)) for i, words in held]
        if len(kept) > known:
            self._learn(list(islice(kept, known, None)))
        return [(i, _gather(self.flat, self.begins[at], self.sizes[at])) for i, at in found]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts, without end ids."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, words, count = [], [], 0
        for i, text in enumerate(texts):
            words = []
            for found in WORD.finditer(" " + text.replace(BLANK, " ")) if text else ():
                words.append(found.group())
                count += 1
                if count >= STEP:
                    for k, ids in self._ids([*held, (i, words)]):
                        out[k].append(ids)
                    held, words, count = [], [], 0
            if words:
                held.append((i, words))
        for k, ids in self._ids(held):
            out[k].append(ids)
        return [np.concatenate(x) if x else np.empty(0, np.int32) for x in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def _characters(run: bytes) -> str:
    """Bytes as the library reads them: a byte that begins no character is U+FFFD, and the next one is looked at."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def decode(model: PieceModel, ids: np.ndarray) -> str:
    """The text of ids: pieces one after the other, runs of byte pieces read as UTF-8, without the blank put before the text."""
    shown = np.flatnonzero(model.kind[ids] != 2)
    if not len(shown):
        return ""
    ids = ids[shown]
    kinds, sizes = model.kind[ids], model.sizes[ids]
    raw = _gather(model.surface, model.begins[ids], sizes).tobytes()
    cut = int(kinds[0] == 0 and raw[:1] == b" " and not raw.startswith(UNKNOWN_SURFACE.encode()))
    apart = np.diff(shown) > 1  # an id without a text ends a run of bytes
    try:
        if not (apart & (kinds[1:] == 1)).any():
            return raw[cut:].decode()
    except UnicodeDecodeError:
        pass
    ends = np.cumsum(sizes)  # each run of byte pieces is read by itself
    edges = np.flatnonzero(np.r_[True, (kinds[1:] != kinds[:-1]) | apart])
    lows, highs = (ends - sizes)[edges], np.r_[ends[edges[1:] - 1], ends[-1]]
    return "".join(_characters(raw[a:b]) if kinds[e] == 1 else raw[a:b].decode() for e, a, b in zip(edges, lows, highs))[cut:]


def encode_texts(docs: DataFrame, model: PieceModel, add_end: bool = True, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id_column and ids (array of int) for every row of docs.

    Texts are read whole and stay where they are; what a task holds besides is a bounded number of words. A null
    text is an empty one: its ids are the end id alone, or none. Repeated rows are encoded row by row, an empty table gives no rows;
    further columns are not read, whatever their names. Nothing depends on the order of rows, so there are no ties.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary, whatever the corpus

    def run(batches):
        encoder = Encoder(sent.value)
        end = np.array([sent.value.end_id] if add_end else [], np.int32)
        for batch in batches:
            found = [np.concatenate([x, end]) for x in encoder.encode_all([x.as_py() for x in batch.column(1)])]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, np.concatenate(found) if found else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_column, "ids"])

    return docs.select(F.col(id_column).cast("long").alias(id_column), F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInArrow(run, f"`{id_column}` long, ids array<int>")


def decode_ids(rows: DataFrame, model: PieceModel, id_column: str = "doc_id") -> DataFrame:
    """id_column, ids and text (what the ids decode to) for every row; null ids are no ids, and their text is empty.
    An id outside the vocabulary is an error."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = [decode(sent.value, x.values.to_numpy(zero_copy_only=False)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_column, "ids", "text"])

    return rows.select(F.col(id_column).cast("long").alias(id_column), F.coalesce(F.col("ids"), F.expr("cast(array() as array<int>)")).alias("ids")).mapInArrow(run, f"`{id_column}` long, ids array<int>, text string")


def coding_report(docs: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, from its ids with an end id and the text they decode to."""
    coded = decode_ids(encode_texts(docs, model), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
