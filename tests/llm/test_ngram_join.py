"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grantspark.llm import ngram_join
from grantspark.llm.common import QUERIES, materialize

from .cases import clashing, frame, prose, rows
from .test_near_copies import corpus, shingle_set


def sets_of(data, k):
    out = []
    for r in data:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in (r[1] or "")).encode().split()]
        out.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    return out


def brute(data, k=4, num=85, den=100):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = sets_of(data, k)
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return Counter((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(data))


def op11(spark, df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op11_ngram_join"](spark, str(folder)).collect())


def test_edge_rows(spark, tmp_path):
    assert op11(spark, clashing(frame(spark)).withColumns({"size": F.lit("x"), "sketch": F.lit(1), "grp": F.lit(1)}), tmp_path) == brute(rows())


def test_empty_table(spark, tmp_path):
    assert op11(spark, frame(spark, []), tmp_path) == Counter()
    assert ngram_join.keep_one(frame(spark, [])).count() == 0


@pytest.mark.parametrize("crowded", [3, 48])
def test_links_are_those_of_all_pairs(spark, tmp_path, monkeypatch, crowded):
    """Families, chains and shared passages, with every bucket crowded, some, or none."""
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    data = corpus()
    rng = random.Random(2)
    base = prose(60, 901).split()
    for i in range(60):  # one word differs: around the threshold, many of one size
        w = list(base)
        w[rng.randrange(60)] = f"n{rng.randrange(4)}"
        data.append((5000 + i, " ".join(w[:rng.randint(50, 60)]), "en", "s", 1))
    assert op11(spark, frame(spark, data), tmp_path) == brute(data)


@pytest.mark.parametrize("crowded", [3, 48])
def test_later_links_join_known_classes(spark, tmp_path, monkeypatch, crowded):
    """Components are found once over the first links; after that only over the links between classes."""
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    seen = []
    monkeypatch.setattr(ngram_join, "components", lambda edges, old=ngram_join.components: (seen.append(edges.count()), old(edges))[1])
    data = corpus()
    # a chain: each text is near its neighbours only
    words = prose(200, 77).split()
    data += [(7000 + i, " ".join(words[3 * i:3 * i + 100]), "en", "s", 1) for i in range(30)]
    assert op11(spark, frame(spark, data), tmp_path) == brute(data)
    assert seen[0] > 30 and sum(seen[1:]) < seen[0]


def test_a_common_passage_makes_few_pairs(spark, monkeypatch):
    """Texts that share no more than a passage: their candidates grow with their number, not with its square."""
    passage, sizes = prose(60, 31), {}
    for n in (500, 2000):
        docs = materialize(frame(spark, [(i, prose(120, 10_000 + i) + " " + passage + " " + prose(100, 50_000 + i), "en", "s", 1) for i in range(n)]), "docs")
        seen = []
        monkeypatch.setattr(ngram_join.Join, "_verified", lambda self, pairs, old=ngram_join.Join._verified: (seen.append(pairs.count()), old(self, pairs))[1])
        assert ngram_join.keep_one(docs).count() == n
        sizes[n] = sum(seen)
        monkeypatch.undo()
    assert sizes[2000] <= 2000 and sizes[2000] <= 8 * max(sizes[500], 50)


def test_keep_one_keeps_every_column(spark):
    data = rows()
    kept = ngram_join.keep_one(clashing(frame(spark, data)).withColumns({"_row": F.lit("a"), "node": F.lit("b"), "id": F.lit("c")}))
    assert {"_row", "node", "id", "row", "score"} <= set(kept.columns) and {r.row for r in kept.collect()} == {"clash"} and {r["_row"] for r in kept.collect()} == {"a"}


def test_shingles_are_sets():
    for r in rows():
        s = ngram_join.shingles((r[1] or "").encode(), 4)
        assert len(s) == len(sets_of([r], 4)[0]) and (s[1:] > s[:-1]).all()
    assert not set(ngram_join.shingles(b"a b c", 4).tolist()) & set(ngram_join.shingles(b"a b c d", 4).tolist())
    assert len(shingle_set("a b c")) == 1
