"""Language, toxicity and quality."""

from __future__ import annotations

import itertools
import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantspark.llm import langid, quality, toxicity
from grantspark.llm.common import vocabulary_path

from .cases import SCHEMA, clashing, frame, prose

MODEL = vocabulary_path("piece_bpe_32k.model")
SPANISH = ("que", "ción", "ado", "los", "ez", "ñ", "mente", "ar", "ll", "os")


def language_rows(n=40):
    return [(i, prose(60, i, SPANISH) if i % 2 else prose(60, i), "es" if i % 2 else "en", None, None) for i in range(n)]


@pytest.fixture(scope="module")
def model():
    return langid.fit([(r[2], r[1]) for r in language_rows()], MODEL)


def test_word_probability_sums_all_segmentations(model):
    ids = {p: i + 2 for i, p in enumerate(langid.vocabulary(MODEL))}

    def brute(word, k):
        marked = "▁" + word
        total = 0.0
        for cuts in itertools.product((0, 1), repeat=len(marked) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(marked)]
            p = 1.0
            for a, b in zip(at, at[1:]):
                i = ids.get(marked[a:b], 1 if b - a == 1 else 0)
                p *= model.prob[i, k]
            total += p
        return total

    words = ["the", "ción", "thing", "ñ", "ж", "menteado"]
    got = model.words(words, langid.Pieces(model.hashes))
    for i, w in enumerate(words):
        for k in range(2):
            assert got[i, k] == pytest.approx(math.log(brute(w, k)), abs=1e-9)


def test_every_piece_is_found():
    pieces = langid.vocabulary(MODEL)
    hashes = langid._hashes(pieces)
    assert len(set(hashes.tolist())) == len(pieces)
    assert (langid.Pieces(hashes).find(hashes) == np.arange(len(pieces)) + 2).all()


def test_languages_and_edge_rows(spark, model):
    fresh = [(i, prose(40, 900 + i, SPANISH) if i % 2 else prose(40, 900 + i), "es" if i % 2 else "en", None, None) for i in range(20)]
    got = langid.identify(frame(spark, fresh), model).collect()
    assert all(r.lang_pred == r.lang and 0.5 < r.lang_score <= 1 for r in got)
    edge = langid.identify(clashing(frame(spark)), model).collect()
    for r in edge:
        assert 0 <= r.lang_score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
    assert langid.identify(frame(spark, []), model).count() == 0
    nothing = langid.trained(frame(spark, []))
    assert {r.lang_pred for r in langid.identify(frame(spark), nothing).collect()} == {"und"}


def test_language_fold_keeps_held_out_rows_out(spark):
    docs = frame(spark, language_rows())
    drawn = langid.sample(docs, ~langid.held_out())
    kept = [r[1] for r in docs.filter(~langid.held_out()).select("doc_id", "text").collect()]
    assert Counter(t for _, t in drawn) == Counter(kept) and len(kept) < 40


# ---- toxicity

def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    toxicity_lane = toxicity.LANE
    try:
        for lane in (2, 3, 256):
            toxicity.LANE = lane
            sizes = [4, 1, 9, 6]
            unary, pair = rng.normal(size=sum(sizes)) * 2, rng.normal(size=(2, 2)) * 2
            first = np.zeros(sum(sizes), bool)
            first[np.cumsum([0, *sizes[:-1]])] = True
            got, _ = toxicity.marginals(unary, first, pair)
            want, at = [], 0
            for n in sizes:
                u, total, mass = unary[at:at + n], 0.0, np.zeros(n)
                for y in itertools.product((0, 1), repeat=n):
                    p = math.exp(sum(a * b for a, b in zip(u, y)) + sum(pair[a, b] for a, b in zip(y, y[1:])))
                    total += p
                    mass += p * np.array(y)
                want.append(mass / total)
                at += n
            assert np.allclose(got, np.concatenate(want))
    finally:
        toxicity.LANE = toxicity_lane


def toxic_rows(n=400):
    out = []
    for i in range(n):
        words = prose(50, 5000 + i).split()
        if i % 5 == 0:
            for k in (7, 8, 30):
                words[k] = ("idiot", "scum", "Vilement" + words[k])[(i // 5 + k) % 3]
        out.append((" ".join(words), int(i % 5 == 0)))
    return out


def test_toxic_documents_and_spans():
    data = toxic_rows()
    model = toxicity.fit(data[:300], 0.2)
    found = toxicity.Tagger(model).texts([t for t, _ in data[300:]])
    assert [int(s >= 0.5) for s, _ in found] == [y for _, y in data[300:]]
    for (text, y), (_, spans) in zip(data[300:], found):
        hit = {text[s["start"]:s["stop"]] for s in spans}
        assert not hit if not y else hit and all(any(w in h for w in ("idiot", "scum", "Vilement")) for h in hit)


def test_a_fit_holds_few_bytes_a_token(monkeypatch):
    """The driver fits beside Spark's own memory: about ten numbers a token at most."""
    monkeypatch.setattr(toxicity, "STEPS", 3)
    data = [(f"{text} {prose(1500, 9000 + i)}", label) for i, (text, label) in enumerate(toxic_rows(200))]
    tokens = sum(len(toxicity._TOKEN.findall(text)) for text, _ in toxicity.distinct(data))
    tracemalloc.start()
    try:
        assert toxicity.fit(data).weights
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert tokens > 200_000 and peak < 85 * tokens


def test_toxicity_edge_rows(spark):
    model = toxicity.fit(toxic_rows(200), 0.2)
    got = toxicity.tag(clashing(frame(spark)), model).collect()
    assert len(got) == frame(spark).count() and all(0 <= r.tox_score <= 1 for r in got)
    assert all(r.tox_score < 0.5 and r.tox_spans == [] for r in got if not r.text)
    assert toxicity.tag(frame(spark, []), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.tox_score for r in toxicity.tag(frame(spark), toxicity.trained(frame(spark), labels)).collect()} == {0.0}


def test_toxicity_learns_from_its_fold_only(spark):
    docs = frame(spark, language_rows())
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    drawn, share = toxicity.sample(docs, labels, ~toxicity.held_out())
    kept = {r.text for r in docs.filter(~toxicity.held_out()).collect()}
    assert {t for t, _ in drawn} == kept and 0 < share < 1


# ---- quality

def slow_statistics(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [s for s in (text or "").split("\n") if s.encode().split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_statistics_edge_rows(spark):
    data = frame(spark).collect() + [(-1, "a b c a b c a b", None, None, None), (-2, "x y z w x y z\nq", None, None, None)]
    df = clashing(spark.createDataFrame(data, SCHEMA))
    for r in quality.word_statistics(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_statistics(r.text), r.doc_id


def test_verdict_does_not_depend_on_the_order(spark):
    stated = quality.word_statistics(frame(spark)).cache()
    rules = list(quality.RULES)
    verdicts = [
        Counter((r.doc_id, r.v is None) for r in stated.select("doc_id", quality.cascade(order).alias("v")).collect()) for order in (rules, rules[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    assert quality.judged(frame(spark, [])).count() == 0


def test_order_is_rejections_per_cost():
    rules = tuple(quality.Rule(n, "true") for n in "abc")
    assert [r.name for r in quality.ordered(rules, {"a": (0.1, 1.0), "b": (0.5, 1.0), "c": (0.5, 10.0)})] == ["b", "a", "c"]


def test_a_rejected_row_skips_later_rules(spark):
    rules = [quality.Rule("first", "id < 5"), quality.Rule("second", "raise_error('evaluated') IS NULL")]
    df = spark.range(5).select("id", F.lit(1).alias("one"))
    assert {r[0] for r in df.select(quality.cascade(rules)).collect()} == {"first"}
