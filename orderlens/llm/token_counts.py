"""Token counts without tokens: best score and number of pieces of a unigram segmentation.

An Aho-Corasick automaton lists every vocabulary piece in the text; dynamic
programming over the end positions carries only the best score and its piece
count, for as many positions as the longest piece has characters.

The tie rule is that of the unigram tokenizers: of equal scores the candidate
that starts earliest wins, because later ones must be strictly better. A
character without a piece of its own is unknown, scores ten below the worst
piece, and counts one piece per UTF-8 byte with byte fallback, else one per run.

Where no piece crosses the start of a word and scores are whole numbers (so that
sums are exact in any order), words are independent; each distinct word is
segmented once and remembered. Otherwise the whole text is one segmentation.
Scores are doubles, as in the tokenizers library. ``single`` keeps them in 32 bits, as
SentencePiece does; that agrees with it on vocabularies of ordinary scores, but scores near
-1e9, which some files give to runs of spaces, leave no precision in 32 bits and the
choice among them is then arbitrary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from orderlens.llm.common import MEMO_WORDS, map_rows, rows_in
from orderlens.llm.sentencepiece_model import PieceModel, normaliser, parse_model, read_file

UNKNOWN_PENALTY = 10.0


class CountingViterbi:
    """(count, score) of the best segmentation of normalised text."""

    def __init__(self, model: PieceModel, single: bool = False):
        self.model, self.single = model, single
        self.pieces = {p.text: p.score for p in model.pieces if p.matchable}
        best = max(self.pieces.values(), default=0.0)
        for piece in model.pieces:
            if piece.user_defined:
                self.pieces[piece.text] = len(piece.text.encode()) * best - 0.1
        normal = [p.score for p in model.pieces if p.normal]
        self.unknown = min(normal, default=0.0) - UNKNOWN_PENALTY
        if single:
            self.unknown = array("f", [self.unknown])[0]
        self.longest = max(map(len, self.pieces), default=1)
        self.automaton = ahocorasick.Automaton()
        for text, score in self.pieces.items():
            self.automaton.add_word(text, (len(text), score))
        self.automaton.make_automaton()
        whole = all(float(s).is_integer() for s in self.pieces.values())
        self.by_word = whole and not single and model.splits_at_words
        self.memo: dict[str, tuple[int, float]] = {}

    def __call__(self, text: str) -> tuple[int, float]:
        if not self.by_word:
            return self.segment(text)
        count, score, memo = 0, 0.0, self.memo
        for word in re.findall("▁*[^▁]+|▁+", text):
            found = memo.get(word)
            if found is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                found = memo[word] = self.segment(word)
            count += found[0]
            score += found[1]
        return count, score

    def segment(self, text: str) -> tuple[int, float]:
        size = self.longest + 1  # a ring: no match reaches back further
        scores = array("f" if self.single else "d", bytes((4 if self.single else 8) * size))
        counts, open_run = [0] * size, [False] * size
        at, pieces, fallback = 0, self.pieces, self.model.byte_fallback
        best, best_from, best_known = 0.0, -1, True
        cell = array("f" if self.single else "d", [0.0])

        def kept(score: float) -> float:
            """The score as the tokenizer keeps it; candidates are compared before they are rounded."""
            cell[0] = score
            return cell[0]

        def close() -> None:
            """Settle position ``at + 1``, whose known candidates have all been seen."""
            nonlocal at, best, best_from, best_known
            char = text[at]
            if char not in pieces:
                score = kept(scores[at % size] + self.unknown)
                if best_from < 0 or score > best:
                    best, best_from, best_known = score, at, False
            here, source = (at + 1) % size, best_from % size
            scores[here] = best
            if best_known:
                counts[here], open_run[here] = counts[source] + 1, False
            elif fallback:
                counts[here], open_run[here] = counts[source] + len(char.encode()), False
            else:
                counts[here], open_run[here] = counts[source] + (not open_run[source]), True
            at, best_from = at + 1, -1

        if self.pieces:
            for end, (length, piece_score) in self.automaton.iter(text):
                while at < end:
                    close()
                start = end + 1 - length
                score = scores[start % size] + piece_score
                if best_from < 0 or score > best:
                    best, best_from, best_known = kept(score), start, True
        while at < len(text):
            close()
        return counts[at % size], scores[at % size]


def token_counts(docs: DataFrame, model_path: str, single: bool = False) -> DataFrame:
    """(doc_id, n_tokens, score) of every row of ``docs`` (doc_id, text).

    Null and empty texts have 0 tokens and score 0; repeated rows repeat; an
    empty table gives none. Other columns are not read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_file(model_path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]):
        model = parse_model(spec.value)
        clean, viterbi = normaliser(model), CountingViterbi(model, single)
        for doc, text in rows_in(batches):
            n, score = viterbi(clean(text)) if text else (0, 0.0)
            yield doc, n, float(score)

    return map_rows(docs.select("doc_id", "text"), count, f"doc_id {kind}, n_tokens long, score double")
