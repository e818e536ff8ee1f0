"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is parsed and rebuilt as a tokenizer: normaliser, space
marks, byte fallback, and the model its type field names. Unigram models keep
their piece scores; BPE models turn the order of the scores into merges. Batches
are encoded by the library's thread pool.

Where no piece crosses the start of a word (and, for unigram, where scores are
whole numbers, so that the best path of a text is that of its words), each
distinct word is encoded once and remembered, within a bound of bytes. Ids and decoded
texts are those of the rebuilt tokenizer. Every newly encoded word is compared with
SentencePiece itself; on a difference (a text that spells out a reserved piece such as
``<s>``, for example) SentencePiece's ids are used and counted. Other models encode and
compare whole texts. A Python worker builds the tokenizer once for all its tasks.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from orderlens.llm.sentencepiece_model import (
    BPE,
    CONTROL,
    SPACE,
    UNKNOWN,
    PieceModel,
    normaliser,
    normalizer,
    parse_model,
    read_file,
)

WORD = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
SLICE_BYTES = 1_000_000
DECODED_ROWS = 256
RUN_WORDS = 500
# What the memory of words may hold, twice, by an estimate of what an entry costs beside its text and ids.
MEMO_BYTES, ENTRY_BYTES = 40_000_000, 220


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """All ways to join two pieces into a piece, best resulting score first."""
    known = {p.text for p in model.pieces if p.matchable}
    found = []
    for number, piece in enumerate(model.pieces):
        if piece.matchable:
            for cut in range(1, len(piece.text)):
                left, right = piece.text[:cut], piece.text[cut:]
                if left in known and right in known:
                    found.append((-piece.score, number, cut, left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: PieceModel) -> Tokenizer:
    """The model as a tokenizer of the tokenizers library."""
    if model.kind == BPE:
        core = models.BPE(
            vocab={p.text: i for i, p in enumerate(model.pieces)}, merges=merges_of(model),
            unk_token=model.pieces[model.unknown_id].text, fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        core = models.Unigram([(p.text, p.score) for p in model.pieces], model.unknown_id, model.byte_fallback)
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizer(model)
    if model.splits_at_words and _word_by_word(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(WORD), "isolated")
    steps = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


def _word_by_word(model: PieceModel) -> bool:
    exact = model.kind == BPE or all(float(p.score).is_integer() for p in model.pieces if p.matchable)
    return exact and model.splits_at_words and not model.charsmap and not model.squeeze_spaces and model.dummy_prefix


class Codec:
    """Encodes and decodes texts by the rebuilt tokenizer, and counts the ids that SentencePiece had to supply."""

    def __init__(self, data: bytes, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model = parse_model(data)
        self.tokenizer = build_tokenizer(self.model)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.threads = threads
        self.by_word = _word_by_word(self.model)
        self.clean = normaliser(self.model)
        self.reserved = {i for i, p in enumerate(self.model.pieces) if p.kind in (CONTROL, UNKNOWN)}
        self.starts = np.array([p.text.startswith(SPACE) for p in self.model.pieces])
        # By word without its leading mark: the ids as 32-bit bytes. Words not met since the last turn are forgotten.
        self.words: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.differing: set[str] = set()
        self.broken: set[str] = set()
        self.held = 0

    def _turn(self) -> None:
        self.earlier, self.words, self.held = self.words, {}, 0
        self.differing &= self.earlier.keys()
        self.broken &= self.earlier.keys()

    def _checked(self, texts: list[str]) -> list[tuple[list[int], bool]]:
        """(ids, equal to SentencePiece's) of whole texts, encoded in parallel; on a difference SentencePiece's."""
        ours = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        theirs = self.original.encode(texts, num_threads=self.threads)
        return [(ids, True) if (ids := a.ids) == b else (b, False) for a, b in zip(ours, theirs)]

    def _remember(self, word: str, ids: bytes) -> None:
        self.words[word] = ids
        self.held += 2 * len(word) + len(ids) + ENTRY_BYTES

    def _learn(self, words: list[str]) -> None:
        """Encode new words and remember them: run by run, and word by word where a run shows a difference."""
        plain = [w for w in words if w and " " not in w and SPACE not in w]
        runs = [plain[i : i + RUN_WORDS] for i in range(0, len(plain), RUN_WORDS)]
        texts = [" ".join(run) for run in runs]
        single = [w for w in words if not w or " " in w or SPACE in w]
        found = self._checked(texts)
        for run, text, (ids, same), back in zip(runs, texts, found, self._decoded([ids for ids, _ in found])):
            flat = np.array(ids, np.int32)
            # Every word of a run starts with the only pieces that start with a mark.
            cuts = np.flatnonzero(self.starts[flat])
            if not same or back != text or len(cuts) != len(run) or cuts[0]:
                single += run
                continue
            data, ends = flat.tobytes(), (4 * cuts).tolist()
            for word, low, high in zip(run, ends, [*ends[1:], len(data)]):
                self._remember(word, data[low:high])
        if single:
            self._learn_singly(single)

    def _learn_singly(self, words: list[str]) -> None:
        found = self._checked(words)
        lone = [self.original.piece_to_id(SPACE)]  # the text "" of a lone mark would be empty
        ids = [lone if not word else own for word, (own, _) in zip(words, found)]
        for word, own, (_, same), text in zip(words, ids, found, self._decoded(ids)):
            self._remember(word, np.array(own, np.int32).tobytes())
            if not same and word:
                self.differing.add(word)
            if text != word:
                self.broken.add(word)

    def _decoded(self, batch: list[list[int]]) -> list[str]:
        """Texts by the rebuilt decoder; it knows no reserved pieces, so SentencePiece decodes lists that hold some."""
        texts = self.tokenizer.decode_batch(batch, skip_special_tokens=False)
        return [self.original.decode(i) if not self.reserved.isdisjoint(i) else t for i, t in zip(batch, texts)]

    def _words(self, text: str) -> list[str]:
        words = text.split(" ")
        if "" not in words:
            return words
        # Runs of spaces: each belongs to the word that follows it.
        return [w[1:].replace(SPACE, " ") for w in re.findall(WORD, self.clean(text))]

    def encode_flat(self, texts: list[str]) -> Iterator[tuple[np.ndarray, int, bool]]:
        """(ids, words or texts where SentencePiece's ids replaced others, decodes to the text) per text."""
        if not self.by_word:
            found = self._checked(texts)
            for text, (ids, same), back in zip(texts, found, self._decoded([ids for ids, _ in found])):
                yield np.array(ids, np.int32), 0 if same else 1, back == text
            return
        if self.held > MEMO_BYTES:
            self._turn()
        parts = [self._words(t) if t else [] for t in texts]
        unknown = {w for words in parts for w in words if w not in self.words}
        for word in unknown & self.earlier.keys():
            self._remember(word, self.earlier[word])
        if new := [w for w in unknown if w not in self.words]:
            self._learn(new)
        for text, words in zip(texts, parts):
            ids = np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32)
            replaced = sum(w in self.differing for w in words) if self.differing else 0
            whole = SPACE not in text and not (self.broken and any(w in self.broken for w in words))
            yield ids, replaced, whole

    def encode(self, texts: list[str]) -> list[tuple[list[int], int]]:
        """(ids, replaced) per text."""
        return [(ids.tolist(), replaced) for ids, replaced, _ in self.encode_flat(texts)]

    def decode(self, ids) -> str:
        return self._decoded([list(ids)])[0]


@lru_cache(maxsize=1)
def shared_codec(data: bytes, threads: int) -> Codec:
    """One codec for all tasks of a Python worker; its memory of words is bounded."""
    return Codec(data, threads)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about SLICE_BYTES bytes, so that a batch of long texts is not expanded at once."""
    start = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += length
        if size >= SLICE_BYTES:
            yield start, i + 1 - start
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts) - start


def encode(docs: DataFrame, model_path: str, threads: int = 2) -> DataFrame:
    """(doc_id, n_pieces, ids, n_replaced, round_trip) of every row of ``docs`` (doc_id, text).

    ``ids`` are those of the rebuilt tokenizer, ``n_replaced`` counts the words where
    SentencePiece had others, which then stand in their place; ``round_trip`` says whether
    decoding the ids gives the text back (a text that holds the space mark itself does not).
    Null and empty texts have no ids; repeated rows repeat; an empty table gives
    none. Other columns are not read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_file(model_path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(spec.value, threads)
        for batch in batches:
            for start, count in _slices(batch.column(1)):
                part = batch.slice(start, count)
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = list(codec.encode_flat(texts))
                ends = np.cumsum([0, *(len(ids) for ids, _, _ in found)])
                values = pa.array(np.concatenate([ids for ids, _, _ in found]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                        pa.array([replaced for _, replaced, _ in found], pa.int64()),
                        pa.array([same for *_, same in found]),
                    ],
                    names=["doc_id", "n_pieces", "ids", "n_replaced", "round_trip"],
                )

    ddl = f"doc_id {kind}, n_pieces long, ids array<int>, n_replaced long, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_file(model_path))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(spec.value, 2)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(start, DECODED_ROWS)
                lists = part.column(1).to_pylist()
                texts = iter(codec._decoded([ids for ids in lists if ids is not None]))
                texts = [None if ids is None else next(texts) for ids in lists]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
