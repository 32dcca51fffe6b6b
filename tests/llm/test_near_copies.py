"""The third stage of the pipeline against all pairs."""

from __future__ import annotations

import random

from grantspark.llm import ngram_join

from .cases import frame, prose


def shingle_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def kept_by_all_pairs(data):
    sets = [shingle_set(r[1]) for r in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(data):
        best.setdefault(find(i), []).append((r[0] is None, r[0] or 0))
    return sorted(min(x) for x in best.values())


def corpus():
    rng = random.Random(5)
    passage = prose(40, 1)
    texts = [None, "", "one two", "One  two", "a b c d e", passage]
    texts += [prose(60, 100 + i) + " " + passage for i in range(30)]
    for g in range(6):
        base = prose(100, 200 + g).split()
        for k in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
            w += [f"end{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 12))]
            texts.append(" ".join(w))
    chain = prose(160, 300).split()
    texts += [" ".join(chain[i:i + 100]) for i in range(0, 60, 6)]
    data = [(None if i % 17 == 3 else i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rng.shuffle(data)
    return data


def test_near_copies_at_four_fifths_go(spark):
    base = prose(104, 9).split()
    copy = [*base[:60], "other", *base[61:]]  # 95 of 105 shingles: far more than two bits may differ
    data = [(1, " ".join(base), "en", "s", 1), (2, " ".join(copy), "en", "s", 1), (3, " ".join([*copy[:20], "x", *copy[21:40], "y", *copy[41:]]), "en", "s", 1)]
    assert sorted(r.doc_id for r in ngram_join.keep_one(frame(spark, data)).collect()) == [i for _, i in kept_by_all_pairs(data)]


def test_near_copies_are_those_of_all_pairs(spark, monkeypatch):
    data = corpus()
    want = kept_by_all_pairs(data)
    for crowded in (3,):
        monkeypatch.setattr(ngram_join, "CROWDED", crowded)
        got = sorted((r.doc_id is None, r.doc_id or 0) for r in ngram_join.keep_one(frame(spark, data)).collect())
        assert got == want
    assert ngram_join.keep_one(frame(spark, [])).count() == 0


def test_stage_uses_the_stage_rule(spark, tmp_path):
    import corpus_pipeline

    data = corpus()
    got = dict(corpus_pipeline.STAGES)["near_copies"](spark, frame(spark, data), str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == kept_by_all_pairs(data)


def test_stage_finds_near_copies_by_fingerprints(spark, tmp_path, monkeypatch):
    """The stage's first links come from SimHash; a find that is no near copy is not kept as a link."""
    import corpus_pipeline
    from grantspark.llm import simhash

    seen, near_pairs = [], simhash.near_pairs
    monkeypatch.setattr(simhash, "near_pairs", lambda texts, **k: seen.append(near_pairs(texts, **k)) or seen[-1])
    base = prose(400, 21).split()
    texts = [" ".join(base), " ".join([*base, "end"]), prose(50, 22), prose(50, 23)]
    data = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, data), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3]
    assert len(seen) == 1 and seen[0].count() >= 1
    # fingerprints that link without similar sets: every pair is offered, only the near copies are one
    monkeypatch.setattr(simhash, "near_pairs", lambda texts, **k: texts.select("node").toDF("a").crossJoin(texts.select("node").toDF("b")).filter("a < b"))
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, data), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3]


def test_all_fingerprints_within_the_radius_are_connected(spark, monkeypatch):
    """The pairs the stage checks first connect what all pairs of fingerprints do, in the middle of a chain too."""
    from grantspark.llm import simhash

    monkeypatch.setattr(simhash, "fingerprint", lambda text, *a: text.cast("long").alias("fingerprint"))
    rng = random.Random(3)
    # 15 is two bits from 3 and from 12, which are four bits apart
    for held in ([3, 12, 15], [7 << 40 ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 62) - 1 for _ in range(300)]):
        held = held + held[:2]  # equal fingerprints of other nodes
        root = list(range(len(held)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        def classes():
            return sorted(sorted(i for i in range(len(held)) if find(i) == r) for r in {find(i) for i in range(len(held))})

        for i in range(len(held)):
            for j in range(i):
                if (held[i] ^ held[j]).bit_count() <= 2:
                    root[find(i)] = find(j)
        want, root[:] = classes(), range(len(held))
        pairs = simhash.near_pairs(spark.createDataFrame([(i, str(x)) for i, x in enumerate(held)], "node long, text string")).collect()
        for a, b in pairs:
            assert (held[a] ^ held[b]).bit_count() <= 2
            root[find(a)] = find(b)
        assert classes() == want
