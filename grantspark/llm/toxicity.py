"""Toxic spans by a linear-chain conditional random field (operator 9).

Tokens are runs of word characters, each toxic or not; weights belong to the word and its beginnings, and to the pair of
neighbouring states. Only documents are labelled, so training tokens are labelled from them: in a toxic document the tokens
with a word or beginning that toxic documents hold far more often than others, in other documents none. The field
is fitted by gradient ascent on the likelihood. Forward-backward gives every token's marginal; a logistic fit on their sum,
density and maximum scores the document, and runs of tokens over one half are its offending offsets.

A null or empty text, or one without a token, has no spans and the score of a document without any toxic mass. If no labelled
document of one of the two kinds is found, every score is 0. Repeated rows and further columns do no harm.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, query, return_memory, table, texts_of, worker_state

#: Bound of the fit: so many labelled documents of either kind.
FIT_DOCS = 1500
#: A word or beginning marks tokens if toxic documents hold it so many times as often, in so many of them, with such a z value.
LIFT, LEAST_DOCS, LEAST_Z = 4.0, 5, 5.0
#: A beginning counts only if toxic documents hold so many different words with it; else the word itself is the evidence.
LEAST_WORDS = 4
BEGINNINGS = range(3, 8)
STEPS = 60
PENALTY = 1.0
#: Tokens of a lane of the vectorised chain.
LANE = 256
KEPT_WORDS = 150_000

_TOKEN = re.compile(r"\w+")


def traits(word: str) -> list[str]:
    """The features of a token: its word and its beginnings."""
    w = word.lower()
    return ["=" + w, *[w[:k] for k in BEGINNINGS if k <= len(w)]]


def odds(unary: np.ndarray, first: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Forward odds (toxic to not) after each token; ``pair[a, b]`` weighs state a followed by b, ``first`` marks texts' first tokens.

    Tokens are cut into lanes that advance together. A lane begins with the last odds of the lane before it, so passes
    repeat until these agree (each pass settles one more lane of a long text for certain; as the recursion contracts, two or
    three passes do).
    """
    n = len(unary)
    lanes = -(-n // LANE)
    x = np.ones(lanes * LANE)
    np.exp(np.clip(unary, -60, 60, out=x[:n]), out=x[:n])
    x = np.ascontiguousarray(x.reshape(lanes, LANE).T)
    new = np.ones(lanes * LANE, bool)
    new[:n] = first
    new = np.ascontiguousarray(new.reshape(lanes, LANE).T)
    (a00, a01), (a10, a11) = np.exp(pair)
    out, start = np.empty_like(x), np.ones(lanes)
    for _ in range(lanes + 1):
        q = start
        for t in range(LANE):
            q = np.where(new[t], x[t], x[t] * (a01 + a11 * q) / (a00 + a10 * q))
            out[t] = q
        again = np.concatenate(([1.0], q[:-1]))
        if np.allclose(again, start, rtol=1e-12, atol=0):
            break
        start = again
    return out.T.reshape(-1)[:n]


def marginals(unary: np.ndarray, first: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that a token is toxic, and the forward odds."""
    if not len(unary):
        return np.zeros(0), np.zeros(0)
    last = np.concatenate((first[1:], [True]))
    ahead = odds(unary, first, pair)
    behind = odds(unary[::-1], last[::-1], pair.T)[::-1]
    # in place, as a driver that fits holds few arrays of all tokens
    p = np.log(ahead)
    p += np.log(behind, out=behind)
    p -= np.clip(unary, -60, 60, out=behind)
    np.exp(np.negative(np.clip(p, -500, 500, out=p), out=p), out=p)
    p += 1
    return np.divide(1, p, out=p), ahead


def summary(p: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Per text: logarithm of the toxic mass, its density, the greatest marginal."""
    mass = np.bincount(text_of, p, n)
    size = np.bincount(text_of, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, text_of, p)
    return np.stack((np.log1p(mass), np.log1p(100 * mass / np.maximum(size, 1)), most), axis=1)


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray | None = None

    def unary(self, word: str) -> float:
        return self.bias + sum(self.weights.get(t, 0.0) for t in traits(word))

    def score(self, found: np.ndarray) -> np.ndarray:
        if self.document is None:
            return np.zeros(len(found))
        return 1 / (1 + np.exp(-np.clip(found @ self.document[1:] + self.document[0], -500, 500)))


def distinct(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Rows less copies and near copies, as a text that repeats is no evidence about its words."""
    from xxhash import xxh64_intdigest

    seen, kept = set(), []
    for text, label in rows:
        words = text.split()
        least = sorted({xxh64_intdigest(" ".join(words[i:i + 6])) for i in range(max(1, len(words) - 5))})[:4]
        if not seen.intersection(least):
            kept.append((text, label))
        seen.update(least)
    return kept


def strong_traits(rows: list[tuple[str, int]]) -> set[str]:
    toxic, other, words = Counter(), Counter(), {}
    for text, label in rows:
        found = set()
        for w in {w.lower() for w in _TOKEN.findall(text)}:
            found.update(traits(w))
            if label:
                for k in BEGINNINGS:
                    words.setdefault(w[:k], set()).add(w)
        (toxic if label else other).update(found)
    n1 = sum(label for _, label in rows)
    n0 = len(rows) - n1
    strong = set()
    for t, a in toxic.items():
        b = other[t]
        if a < LEAST_DOCS or a / n1 < LIFT * b / n0 or not t.startswith("=") and len(words[t]) < LEAST_WORDS:
            continue
        pooled = (a + b) / (n1 + n0)
        if (a / n1 - b / n0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0)) >= LEAST_Z:
            strong.add(t)
    return strong


def fit(rows: list[tuple[str, int]], share: float = 0.5) -> Model:
    """Fit on (text, toxic) rows; ``share`` is the share of toxic documents outside the sample."""
    rows = distinct(rows)
    labels = np.array([label for _, label in rows], float)
    if not len(rows) or labels.min() == labels.max():
        return Model()
    strong = strong_traits(rows)
    names = {t: i for i, t in enumerate(sorted(strong))}
    token_at, trait_at = array("q"), array("q")
    known: dict[str, list[int]] = {}
    sizes = np.zeros(len(rows), np.int64)
    n = 0
    for d, (text, _) in enumerate(rows):
        for w in _TOKEN.findall(text):
            if w not in known:
                known[w] = [names[t] for t in traits(w) if t in names]
            if known[w]:
                token_at.extend([n] * len(known[w]))
                trait_at.extend(known[w])
            n += 1
        sizes[d] = n
    sizes = np.diff(sizes, prepend=0)
    del known
    token_at, trait_at = (np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (token_at, trait_at))
    # tokens with a strong trait are toxic in toxic documents
    y = np.zeros(n)
    y[token_at] = 1
    y *= np.repeat(labels != 0, sizes)
    first = np.zeros(n, bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    follows = ~first[1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][follows].astype(int), y[1:][follows].astype(int)), 1)
    theta = np.concatenate((np.zeros(len(names)), [np.log((y.sum() + 1) / (n - y.sum() + 1))], np.zeros(4)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        gradient = _gradient(theta, token_at, trait_at, y, first, follows, seen)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Model({t: float(theta[i]) for t, i in names.items()}, float(theta[len(names)]), theta[len(names) + 1:].reshape(2, 2).copy())
    p, _ = marginals(model.bias + np.bincount(token_at, theta[:len(names)][trait_at], n), first, model.pair)
    model.document = _logistic(summary(p, np.repeat(np.arange(len(rows)), sizes), len(rows)), labels, share)
    return model


def _gradient(theta: np.ndarray, token_at: np.ndarray, trait_at: np.ndarray, y: np.ndarray, first: np.ndarray, follows: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Gradient of the likelihood; what it works out for each token is given up before the next step."""
    names = len(theta) - 5
    weights, bias, pair = theta[:names], theta[names], theta[names + 1:].reshape(2, 2)
    p, ahead = marginals(bias + np.bincount(token_at, weights[trait_at], len(y)), first, pair)
    # of each neighbouring pair: the states' joint probabilities, from forward odds and the later marginal
    before, after = ahead[:-1][follows], p[1:][follows]
    del ahead
    e = np.exp(pair)
    to1, to0 = e[1, 1] * before / (e[0, 1] + e[1, 1] * before), e[1, 0] * before / (e[0, 0] + e[1, 0] * before)
    del before
    expected = np.array([[((1 - after) * (1 - to0)).sum(), (after * (1 - to1)).sum()], [((1 - after) * to0).sum(), (after * to1).sum()]])
    del after, to1, to0
    off = y - p
    return np.concatenate((np.bincount(trait_at, off[token_at], names), [off.sum()], (seen - expected).ravel())) - PENALTY * np.concatenate((weights, [0], pair.ravel()))


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Newton steps of a weighted, lightly penalised logistic fit; rows count as often as their kind does outside the sample."""
    x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    row = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (row * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (row * (y - p)) - 1e-2 * w)
    return w


class Tagger:
    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def texts(self, texts: list[str]) -> list[tuple[float, list[dict]]]:
        """(score, spans) of each text."""
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known, cut = self.known, [_TOKEN.findall(t) for t in texts]
        for w in {w for words in cut for w in words if w not in known}:
            known[w] = self.model.unary(w)
        sizes = np.array([len(words) for words in cut], np.int64)
        unary = np.array([known[w] for words in cut for w in words], float)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        first = np.zeros(len(unary), bool)
        first[starts[:-1][sizes > 0]] = True
        p, _ = marginals(unary, first, self.model.pair)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        scores = self.model.score(summary(p, text_of, len(texts)))
        spans: list[list[dict]] = [[] for _ in texts]
        if self.model.document is not None:
            for d in np.unique(text_of[p > 0.5]).tolist():
                spans[d] = self.spans(texts[d], p[starts[d]:starts[d + 1]])
        return list(zip(scores.tolist(), spans))

    @staticmethod
    def spans(text: str, p: np.ndarray) -> list[dict]:
        found, at = [], -2
        for k, m in enumerate(_TOKEN.finditer(text)):
            if p[k] > 0.5:
                if k == at + 1:
                    found[-1]["stop"] = m.end()
                else:
                    found.append({"start": m.start(), "stop": m.end()})
                at = k
        return found


def sample(docs: DataFrame, labels: DataFrame, train: Column, most: int = FIT_DOCS) -> tuple[list[tuple[str, int]], float]:
    """Labelled training texts, at most ``most`` of either kind, drawn by a hash of the id; and the share of toxic ones."""
    known = labels.filter(train & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {int(r[0]): r[1] for r in known.groupBy("toxic").count().collect() if r[0] in (0, 1)}
    if len(sizes) < 2:
        return [], 0.5
    drawn = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in sizes]
    rows = docs.filter(F.col("text").isNotNull()).join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").select("doc_id", "text", "toxic").limit(4 * most).collect()
    return [(r.text, int(r.toxic)) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))], sizes[1] / sum(sizes.values())


def tag(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add tox_score and tox_spans (character offsets, stop excluded); only the text is read."""
    key = ("toxicity", hash((model.bias, tuple(sorted(model.weights.items())))))

    @F.arrow_udf("score double, spans array<struct<start:int,stop:int>>")
    def tagged(column: pa.Array) -> pa.Array:
        tagger = worker_state(key, lambda: Tagger(model))
        found = [x for run in texts_of(column, 2 << 20) for x in tagger.texts(run)]
        spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array([s for _, s in found], spans)], ["score", "spans"])

    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("tox_score", "tox_spans", "_tox")]
    return docs.select(*others, tagged(F.col(text_col)).alias("_tox")).select(*others, F.col("_tox.score").alias("tox_score"), F.col("_tox.spans").alias("tox_spans"))


def held_out() -> Column:
    return F.coalesce(crc_of_id("doc_id") % 5 == 0, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCS) -> Model:
    model = fit(*sample(docs, labels, ~held_out(), most))
    return_memory()
    return model


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tag(docs, trained(docs, table(spark, folder, "labels"))).select(
        "doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted")
    )
