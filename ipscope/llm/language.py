"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  The
probability of a word is the sum over all ways to cut it into pieces, by the forward
algorithm; a text scores the product over its words.  The probabilities are learned
by expectation-maximisation over the same segmentations.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ipscope.llm.common import held, slices, staged

LETTERS = regex.compile(r"\p{L}+")
START = "▁"  # the vocabulary's mark before a word
BASE = np.uint64(0x9E3779B97F4A7C15)  # of the rolling hash, modulo 2**64
LONGEST = 48  # letters scored in one run; longer words are scored in such runs
UNKNOWN = 1e-7  # of a letter that is no piece, in every language


def vocabulary(path: str) -> list[str]:
    """Pieces of a SentencePiece model made of letters, with or without the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == START or LETTERS.fullmatch(p.removeprefix(START)))


class Segmenter:
    """Pieces found in many words at once, and sums over their segmentations.

    ``prob`` has a row per piece and a column per language; a last row stands for
    letters that are no piece.
    """

    def __init__(self, pieces: list[str], prob: np.ndarray):
        self.prob = np.vstack([prob, np.full(prob.shape[1], UNKNOWN)])
        self.longest = max(map(len, pieces), default=1)
        self.power = np.ones(LONGEST + 2, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(1, len(self.power)):
                self.power[i] = self.power[i - 1] * BASE
        codes = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            codes[i] = self._prefix([p])[len(p), 0]
        self.order = np.argsort(codes)
        self.hashes = codes[self.order]
        # Most substrings are no piece; 20 bits of the hash tell that of nearly all of them.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes >> np.uint64(44)] = True

    @staticmethod
    def blocks(words: list[str], most: int = 4096) -> Iterator[np.ndarray]:
        """Places of words of equal length, at most ``most`` at a time."""
        if not len(words):
            return
        size = np.array([len(w) for w in words])
        order = np.argsort(size, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            yield from (same[i:i + most] for i in range(0, len(same), most))

    def _prefix(self, words: list[str]) -> np.ndarray:
        """Hashes of the first 0, 1, ... letters: a row for each end, a column for each word (of equal length)."""
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).T.astype(np.uint64)
        out = np.zeros((len(letters) + 1, len(words)), np.uint64)
        with np.errstate(over="ignore"):
            for i, row in enumerate(letters):
                out[i + 1] = out[i] * BASE + row + np.uint64(1)
        return out

    def lattice(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words of equal length, by end, then start: the words that have a piece there, and their pieces."""
        prefix = self._prefix(words)
        for end in range(1, len(prefix)):
            for start in range(max(0, end - self.longest), end):
                with np.errstate(over="ignore"):
                    key = prefix[end] - prefix[start] * self.power[end - start]
                hit = np.flatnonzero(self.maybe[key >> np.uint64(44)])
                key = key[hit]
                at = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
                known = self.hashes[at] == key
                hit, piece = hit[known], self.order[at[known]]
                if end - start == 1 and len(hit) < len(words):
                    every = np.full(len(words), len(self.prob) - 1)
                    every[hit] = piece
                    hit, piece = np.arange(len(words)), every
                if len(hit):
                    yield start, end, hit, piece

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), self.prob.shape[1]))
        for rows in self.blocks(words):
            alpha = np.zeros((len(words[rows[0]]) + 1, len(rows), self.prob.shape[1]))
            alpha[0] = 1.0
            for start, end, hit, piece in self.lattice([words[i] for i in rows]):
                alpha[end, hit] += alpha[start, hit] * self.prob[piece]
            out[rows] = np.log(np.maximum(alpha[-1], 1e-300))
        return out

    def expected(self, words: list[str], times: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Expected uses of each piece per language over all segmentations of the words."""
        total = np.zeros_like(self.prob)
        for rows in self.blocks(words, 2048):
            lang = language[rows]
            alpha = np.zeros((len(words[rows[0]]) + 1, len(rows)))
            beta = np.zeros_like(alpha)
            alpha[0] = beta[-1] = 1.0
            edges = [(s, e, h, p, self.prob[p, lang[h]]) for s, e, h, p in self.lattice([words[i] for i in rows])]
            for s, e, h, _, q in edges:
                alpha[e, h] += alpha[s, h] * q
            for s, e, h, _, q in sorted(edges, key=lambda x: -x[0]):
                beta[s, h] += beta[e, h] * q
            weight = times[rows] / np.maximum(alpha[-1], 1e-300)
            for s, e, h, piece, q in edges:
                np.add.at(total, (piece, lang[h]), alpha[s, h] * q * beta[e, h] * weight[h])
        return total


_ASCII_WORDS = {c: chr(c) if chr(c).isalpha() else " " for c in range(128)}


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    low = text.lower()
    return low.translate(_ASCII_WORDS).split() if low.isascii() else LETTERS.findall(low)


def runs(word: str) -> list[str]:
    """A word marked, in runs of a length that can be scored."""
    marked = START + word
    return [marked[i:i + LONGEST] for i in range(0, len(marked), LONGEST)]


def _with_schema(rows: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(rows.values()), names=list(rows))


class LanguageModel:
    """Languages, pieces and probabilities (vocabulary times languages in size)."""

    def __init__(self, languages: list[str], pieces: list[str], prob: np.ndarray):
        self.languages, self.pieces, self.prob = languages, pieces, prob


def fit(docs: DataFrame, vocabulary_path: str, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        rows_per_language: int = 2500, rounds: int = 3, smoothing: float = 0.1) -> LanguageModel:
    """Learn from documents with a language and a text.

    About ``rows_per_language`` documents of each language are used, picked by a
    digest of doc_id, so the fit costs the same for any corpus; their word counts are
    made and the expectations computed in tasks, and the driver holds vocabulary
    times languages numbers.  Without any labelled text the model has no language.
    """
    pieces = vocabulary(vocabulary_path)
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one per language
    languages = sorted(sizes)
    number = {x: i for i, x in enumerate(languages)}
    prob = np.full((len(pieces), len(languages)), 1.0 / max(1, len(pieces)))
    if not languages:
        return LanguageModel(languages, pieces, prob)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.0)
    for x, n in sizes.items():
        share = F.when(F.col("lang") == x, F.lit(min(1.0, rows_per_language / n))).otherwise(share)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in slices(batches, "text"):
            for x, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                counts.update((number[x], w) for w in chain.from_iterable(map(runs, words_of(t))))
        yield _with_schema({"lang": pa.array([k[0] for k in counts], pa.int32()),
                            "word": pa.array([k[1] for k in counts], pa.string()),
                            "n": pa.array(list(counts.values()), pa.int64())})

    counted = staged(labelled.filter(place < share).select("lang", "text").mapInArrow(words, "lang int, word string, n long")
                     .groupBy("lang", "word").agg(F.sum("n").cast("double").alias("n")), "language_words")
    for _ in range(rounds):
        model = docs.sparkSession.sparkContext.broadcast((pieces, prob))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            segmenter = Segmenter(*model.value)
            total = np.zeros_like(segmenter.prob)
            for b in batches:
                total += segmenter.expected(b.column("word").to_pylist(), b.column("n").to_numpy(),
                                            b.column("lang").to_numpy())
            piece, language = np.nonzero(total[:-1])
            yield _with_schema({"piece": pa.array(piece, pa.int64()), "lang": pa.array(language, pa.int64()),
                                "uses": pa.array(total[piece, language], pa.float64())})

        uses = np.zeros_like(prob)
        for r in (counted.mapInArrow(expect, "piece long, lang long, uses double")
                  .groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toLocalIterator()):
            uses[r.piece, r.lang] = r.uses
        prob = (uses + smoothing) / (uses.sum(axis=0) + smoothing * len(pieces))
        model.unpersist()
    return LanguageModel(languages, pieces, prob)


class TextScorer:
    """Scores texts; a worker keeps the scores of up to ``most`` distinct words, then starts anew."""

    def __init__(self, segmenter: Segmenter, most: int = 400_000):
        self.segmenter, self.most = segmenter, most
        self.place: dict[str, int] = {}
        self.scores = np.zeros((1 << 14, segmenter.prob.shape[1]))

    def _learn(self, words: set[str]) -> None:
        if len(self.place) > self.most:
            self.place = {}
        new = list(words - self.place.keys())
        if not new:
            return
        done = len(self.place)
        while len(self.scores) < done + len(new):
            self.scores = np.vstack([self.scores, np.zeros_like(self.scores)])
        long = [i for i, w in enumerate(new) if len(w) >= LONGEST]
        score = self.segmenter.forward([START + w[:LONGEST - 1] for w in new])
        for i in long:  # the first run is scored already
            score[i] += self.segmenter.forward(runs(new[i])[1:]).sum(axis=0)
        self.scores[done:done + len(new)] = score
        self.place.update(zip(new, range(done, done + len(new))))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability per language, and the number of words, of each text."""
        parts = [words_of(x) for x in texts]
        self._learn(set().union(*parts))
        size = np.array([len(p) for p in parts])
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(parts)), np.int64, int(size.sum()))
        out = np.zeros((len(texts), self.scores.shape[1]))
        full = np.flatnonzero(size)
        if len(full):
            out[full] = np.add.reduceat(self.scores[at], (np.cumsum(size) - size)[full], axis=0)
        return out, size


def label(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred",
          score: str = "score") -> DataFrame:
    """The rows of ``docs`` with the language of their whole text and its score added.

    score is the posterior of the predicted language with all languages alike
    beforehand.  A text that is null or has no letter, and any text where the model
    knows no language, gives ``und`` with score 0; of equal scores the first
    language by name is taken.  Repeated rows repeat; nothing but the text is used.
    ``lang`` and ``score`` must be no columns of ``docs``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.pieces, model.prob))  # vocabulary times languages
    languages, key = model.languages, uuid.uuid4().hex
    schema = StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held("language", key, lambda: TextScorer(Segmenter(*shared.value))) if languages else None
        for b in slices(batches, text):
            names, best = ["und"] * b.num_rows, np.zeros(b.num_rows)
            if languages:
                column = b.column(b.schema.get_field_index(text))
                log, size = scorer.score([x or "" for x in column.to_pylist()])
                top = log.argmax(axis=1)
                odds = np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
                known = size > 0
                names = [languages[t] if k else "und" for t, k in zip(top, known)]
                best = np.where(known, 1.0 / odds, 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(best, pa.float64())],
                                             names=[*b.schema.names, lang, score])

    return docs.mapInArrow(run, schema)


def lettered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter; all others are ``und`` whatever a model knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            column = b.column(b.schema.get_field_index(text))
            yield b.filter(pa.array([LETTERS.search((x or "").lower()) is not None for x in column.to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Language of every whole text: doc_id, lang_pred, score; as ``label`` gives them."""
    return label(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model).drop("text")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
