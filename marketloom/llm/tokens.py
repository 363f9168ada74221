"""Token counts of a unigram tokenizer, without making the tokens.

A text is cut before each blank, as the tokenizer cuts it, and no piece crosses such a cut,
so the count of a text is the sum over its parts. For a part, an Aho-Corasick automaton over
the vocabulary gives every piece that ends at each character, and a dynamic program carries
the best score and the pieces it takes. The rules of ties are the tokenizer's: a later
candidate replaces an earlier one only if its score is strictly greater, and candidates come in
the order of their start, so of equal paths the one with the longest last piece stays; where
no single-character piece starts, an unknown one does, at the lowest score of the vocabulary
less ten; a run of unknown characters is spelt in UTF-8 bytes.
"""

from __future__ import annotations

from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import small_batches

#: Where the public vocabulary files are; a parameter of every function that reads one.
TOKENIZERS = "/opt/tokenizers"
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: Distinct parts whose count a task keeps before it starts anew, and the longest part kept.
CACHE, LONGEST_KEPT = 300_000, 64
#: Steps of the dynamic program that are held at a time in a part without a blank, however long it is.
KEPT_STEPS = 1 << 14


def load_vocabulary(path: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, in the order of their ids, as unigram entries."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts pieces. Entry 0 of the vocabulary is the unknown piece."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        if any(BLANK in piece.lstrip(BLANK) for piece, _ in vocabulary):
            raise ValueError("a piece crosses a blank: texts cannot be cut there")
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.longest = max(len(piece) for piece, _ in vocabulary)
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.kept: dict[str, tuple[int, float]] = {}

    def part(self, part: str) -> tuple[int, float]:
        """Pieces and score of the best path through one part."""
        best, pieces, base = [0.0], [0], 0  # of the characters from base on
        single, unknown = self.single, self.unknown
        at, top, count = 0, None, 0
        for end, (length, score) in chain(self.automaton.iter(part), (((len(part), (0, 0.0))),)):
            while at < end:  # no more pieces end at this character
                if part[at] not in single:
                    total = unknown + best[at - base]
                    if top is None or total > top:
                        top, count = total, pieces[at - base] + len(part[at].encode("utf-8", "surrogatepass"))
                best.append(top)
                pieces.append(count)
                at, top = at + 1, None
            if len(best) > KEPT_STEPS:  # no piece reaches further back than the longest
                drop = len(best) - self.longest - 1
                del best[:drop], pieces[:drop]
                base += drop
            if length:  # at one end the automaton gives the longest first: the order of their starts
                start = end + 1 - length - base
                total = score + best[start]
                if top is None or total > top:
                    top, count = total, pieces[start] + 1
        return pieces[-1], best[-1]

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and score of a whole text; nothing for an empty one."""
        if not text:
            return 0, 0.0
        text = text.replace(BLANK, " ")
        parts = text.split(" ")
        if text[0] == " ":
            del parts[0]
        kept, count, score = self.kept, 0, 0.0
        for x in parts:
            found = kept.get(x)
            if found is None:
                found = self.part(BLANK + x)
                if len(x) <= LONGEST_KEPT:
                    if len(kept) >= CACHE:
                        kept.clear()
                    kept[x] = found
            count += found[0]
            score += found[1]
        return count, score


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id_column, n_tokens, best_score, n_chars for every row of docs.

    Texts are read whole and stay where they are; of a long text without a blank only the last steps
    of the program are held. A null text has no tokens and no characters; repeated rows are counted row by
    row. An empty table gives no rows; further columns are not read, whatever their names.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a vocabulary, whatever the corpus

    def run(batches):
        counter = Counter(sent.value)
        for batch in batches:
            texts = [x.as_py() for x in batch.column(1)]
            found = [counter.text(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.float64()), pa.array([len(x) for x in texts], pa.int64())],
                names=[id_column, "n_tokens", "best_score", "n_chars"])

    return docs.select(F.col(id_column).cast("long").alias(id_column), F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInArrow(
        run, f"`{id_column}` long, n_tokens long, best_score double, n_chars long")
