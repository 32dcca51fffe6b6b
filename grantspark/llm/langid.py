"""Language identification by segmentation-marginalised unigrams (operator 1).

The pieces of a fixed public vocabulary get a probability per language. The probability of a word is the sum over all ways
to segment it into pieces, computed by a forward recursion; a text is the product of its words (runs of letters, lower case, with
the vocabulary's word-start mark). The piece probabilities are fitted by expectation maximisation over the same sums.

Words repeat, so a worker scores each distinct word once, for all languages at a time, vectorised over words of one length.

A null text, or one without a letter, is ``und`` with score 0. Words over WORD_CHARS letters are cut into runs of that
length; a letter no piece covers counts the same in every language. Learning uses rows with a text, a language and an id of the
training fold; without any, every text is ``und``. Repeated rows and further columns do no harm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, query, return_memory, table, texts_of, vocabulary_path, worker_state

#: Bound of the fit: about so many documents of each language.
FIT_DOCS = 1500
EM_ROUNDS = 4
SMOOTHING = 0.02
UNKNOWN = 1e-7
WORD_CHARS = 40
#: Letters of the longest piece considered, with the word-start mark.
PIECE_CHARS = 12
#: Words whose scores a worker remembers.
KEPT_WORDS = 150_000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 20


def words_of(text: str) -> list[str]:
    found = _LETTERS.findall(text.lower())
    if not text.isascii() and not all(map(str.isalpha, found)):  # the pattern also takes signs such as one half
        found = [p for w in found for p in "".join(c if c.isalpha() else " " for c in w).split()]
    if len(text) > WORD_CHARS and any(len(w) > WORD_CHARS for w in found):
        return [w[i:i + WORD_CHARS] for w in found for i in range(0, len(w), WORD_CHARS)]
    return found


def vocabulary(model_path: str) -> list[str]:
    """Pieces of letters, some with the word-start mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))}
    return sorted(p for p in pieces if len(p) <= PIECE_CHARS and p.lower() == p and (p.removeprefix(_START) or _START).replace(_START, "a").isalpha())


def _codes(words: list[str]) -> np.ndarray:
    """Code points, one row per word; all words have the same length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _hashes(pieces: list[str]) -> np.ndarray:
    out = np.zeros(len(pieces), np.uint64)
    sizes = np.array([len(p) for p in pieces])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        h = np.zeros(len(at), np.uint64)
        for column in _codes([pieces[i] for i in at]).T:
            h = (h + column) * _BASE
        out[at] = h
    return out


class Pieces:
    """Finds the pieces of many words at once; id 0 is no piece, 1 a single unknown letter, then the vocabulary."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.slots = np.zeros(1 << _SLOT_BITS, np.int32)
        self.hashes = np.concatenate((np.zeros(2, np.uint64), hashes))
        slot = self._slot(hashes)
        self.slots[slot] = np.arange(len(hashes)) + 2
        lost = np.flatnonzero(self.slots[slot] != np.arange(len(hashes)) + 2)
        order = lost[np.argsort(hashes[lost])]
        self.rest, self.rest_ids = hashes[order], (order + 2).astype(np.int32)

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        ids = self.slots[self._slot(h)]
        ids = np.where(self.hashes[ids] == h, ids, 0)
        at = np.minimum(np.searchsorted(self.rest, h), len(self.rest) - 1) if len(self.rest) else None
        return ids if at is None else np.where(self.rest[at] == h, self.rest_ids[at], ids)

    def segments(self, words: list[str]) -> list[list[tuple[int, np.ndarray]]]:
        """By end position (from 1) of words of one length: (start, piece ids) of the pieces that end there in any word."""
        codes = _codes([_START + w for w in words])
        n = codes.shape[1]
        ends: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            h = np.zeros(len(words), np.uint64)
            for j in range(i, min(n, i + PIECE_CHARS)):
                h = (h + codes[:, j]) * _BASE
                ids = self.find(h)
                if j == i:
                    ids = np.where(ids == 0, 1, ids)
                if ids.any():
                    ends[j + 1].append((i, ids))
        return ends


def forward(ends, prob: np.ndarray, m: int) -> list[np.ndarray]:
    """Sums over the segmentations of every prefix; ``prob`` has a row per piece id and a column per language."""
    sums = [np.ones((m, prob.shape[1]))]
    for j in range(1, len(ends)):
        now = np.zeros((m, prob.shape[1]))
        for i, ids in ends[j]:
            now += sums[i] * prob[ids]
        sums.append(now)
    return sums


def _by_length(words: list[str], most: int = 20_000):
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    start = 0
    while start < len(order):
        stop = start
        while stop < len(order) and stop - start < most and len(words[order[stop]]) == len(words[order[start]]):
            stop += 1
        yield order[start:stop]
        start = stop


@dataclass
class Model:
    languages: list[str]
    hashes: np.ndarray
    prob: np.ndarray
    prior: np.ndarray

    def words(self, words: list[str], pieces: Pieces) -> np.ndarray:
        """Log probability of each word (row) in each language (column)."""
        out = np.zeros((len(words), len(self.languages)))
        for at in _by_length(words):
            some = [words[i] for i in at]
            out[at] = np.log(forward(pieces.segments(some), self.prob, len(some))[-1])
        return out


def fit(texts: list[tuple[str, str]], model_path: str, rounds: int = EM_ROUNDS) -> Model:
    """Expectation maximisation on (language, text) pairs, at most a bounded sample."""
    pieces = vocabulary(model_path)
    hashes = _hashes(pieces)
    finder = Pieces(hashes)
    languages = sorted({lang for lang, _ in texts})
    counts: dict[str, dict[str, int]] = {lang: {} for lang in languages}
    documents = np.zeros(len(languages))
    for lang, text in texts:
        documents[languages.index(lang)] += 1
        of = counts[lang]
        for w in words_of(text):
            of[w] = of.get(w, 0) + 1
    prob = np.zeros((len(pieces) + 2, len(languages)))
    for k, lang in enumerate(languages):
        words = list(counts[lang])
        n = np.array([counts[lang][w] for w in words], float)
        p = np.full((len(pieces) + 2, 1), 1.0 / (len(pieces) or 1))
        p[0], p[1] = 0, UNKNOWN
        groups = [(n[at], finder.segments([words[i] for i in at])) for at in _by_length(words)]
        for _ in range(rounds):
            expected = np.zeros(len(pieces) + 2)
            for weight, ends in groups:
                sums = forward(ends, p, len(weight))
                back = [np.zeros((len(weight), 1)) for _ in ends]
                back[-1][:] = 1
                for j in range(len(ends) - 1, 0, -1):
                    for i, ids in ends[j]:
                        step = p[ids] * back[j]
                        expected += np.bincount(ids, (weight[:, None] * sums[i] * step / sums[-1])[:, 0], len(expected))
                        back[i] += step
            expected[:2] = 0
            p = ((expected + SMOOTHING) / (expected.sum() + SMOOTHING * len(pieces)))[:, None]
            p[0], p[1] = 0, UNKNOWN
        prob[:, k] = p[:, 0]
    return Model(languages, hashes, prob, np.log(documents / documents.sum()) if len(languages) else documents)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.pieces = model, Pieces(model.hashes)
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def texts(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if len(self.rows) > KEPT_WORDS:
            self.rows, self.scores = {}, self.scores[:0]
        cut = [words_of(t) for t in texts]
        new = list({w for words in cut for w in words if w not in self.rows})
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.scores = np.concatenate((self.scores, self.model.words(new, self.pieces)))
        rows, names, best = self.rows, [], np.zeros(len(texts))
        for d, words in enumerate(cut):
            if not words or not self.model.languages:
                names.append(UNDETERMINED)
                continue
            total = self.scores[[rows[w] for w in words]].sum(axis=0) + self.model.prior
            k = int(total.argmax())
            names.append(self.model.languages[k])
            best[d] = 1 / np.exp(total - total[k]).sum()
        return names, best


def sample(docs: DataFrame, train: Column, per_language: int = FIT_DOCS) -> list[tuple[str, str]]:
    """About ``per_language`` training texts of each language, drawn by a hash of the row."""
    known = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])[F.col("lang")]
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < share * float(1 << 30))
    return [(r.lang, r.text) for r in drawn.select("lang", "text").limit(2 * per_language * len(sizes)).collect()]


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add lang_pred and lang_score; only the text is read."""
    key = ("langid", hash((tuple(model.languages), model.prob.tobytes())))

    @F.arrow_udf("lang string, score double")
    def scored(column: pa.Array) -> pa.Array:
        scorer = worker_state(key, lambda: Scorer(model))
        found = [scorer.texts(run) for run in texts_of(column, 2 << 20)]
        return pa.StructArray.from_arrays(
            [pa.array([n for names, _ in found for n in names], pa.string()), pa.array(np.concatenate([b for _, b in found] or [np.zeros(0)]))], ["lang", "score"]
        )

    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "lang_score", "_lang")]
    return docs.select(*others, scored(F.col(text_col)).alias("_lang")).select(*others, F.col("_lang.lang").alias("lang_pred"), F.col("_lang.score").alias("lang_score"))


def held_out() -> Column:
    return F.coalesce(crc_of_id("doc_id") % 3 == 1, F.lit(False))


def trained(docs: DataFrame, per_language: int = FIT_DOCS) -> Model:
    model = fit(sample(docs, ~held_out(), per_language), vocabulary_path("piece_bpe_32k.model"))
    return_memory()
    return model


@query("op1_langid")
def op1_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify(docs.select("doc_id", "text"), trained(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )
