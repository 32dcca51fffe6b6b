"""Merkle manifest and cross-tokenizer alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from grantspark.llm import alignment, manifest
from grantspark.llm.common import QUERIES, materialize

from .cases import clashing, frame, prose, rows

AT = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


# ---- manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(data):
    """Rows of op12 by building the tree as it is defined."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in data:
        leaf = h(*map(field, (doc_id, source, lang, n_chars, text)))
        other = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            other = h(*map(field, (doc_id, source, lang, n_chars, low)))
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, other))

    def tree(nodes):
        """root, and of each node the runs (left, right) on its way up"""
        paths, own = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, at in enumerate(own):
                run = at // 8 * 8
                paths[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
            nodes, own = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [at // 8 for at in own]
        return nodes[0], paths

    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort()
        trees[lang] = tree([x[2] for x in groups[lang]])
    root, over = tree([trees[lang][0] for lang in langs])
    out = []
    for lang, up in zip(langs, over):
        subroot, paths = trees[lang]
        for (known, doc_id, leaf, other), path in zip(groups[lang], paths):
            node = other
            for left, right in path + up:
                node = h(left, node, right)
            out.append((doc_id if known else None, leaf, subroot, root, h(*(a + b for a, b in path + up)), node, node == root))
    return out


def op12(spark, df, tmp_path):
    folder = str(tmp_path / "docs")
    df.write.parquet(f"{folder}/documents.parquet")
    return [tuple(r) for r in QUERIES["op12_manifest"](spark, folder).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def test_manifest_edge_rows(spark, tmp_path):
    assert Counter(op12(spark, clashing(frame(spark)).withColumn("_at", F.lit(1)), tmp_path)) == Counter(brute_manifest(rows()))


def test_manifest_of_many_blocks_and_languages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "DIGITS", 1)  # several rounds on few rows
    rng = random.Random(4)
    data = [(i, f"Text {i}", rng.choice(["en"] * 30 + [None, "é", "z", "", *(f"l{k}" for k in range(20))]), "s", i) for i in range(700)]
    data += [(5, "Same", "en", "s", 1)] * 40
    assert Counter(op12(spark, frame(spark, data), tmp_path)) == Counter(brute_manifest(data))


def test_manifest_of_one_and_none(spark, tmp_path):
    data = [(7, "Only", None, None, None)]
    assert op12(spark, frame(spark, data), tmp_path) == brute_manifest(data)
    assert manifest.manifest(frame(spark, []).select("doc_id", "lang", F.lit("x").alias("leaf"), F.lit("y").alias("changed"))).count() == 0


def test_manifest_needs_one_exchange_per_block(spark):
    nodes = spark.range(5000).select((F.col("id") % 3).alias("g"), F.lit(1667).cast("long").alias("n"), F.col("id").alias("r"), F.lit("h").alias("hash"), F.lit(None).cast("int").alias("load"))
    nodes = materialize(nodes, "nodes")
    plan = manifest.rolled(nodes, 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


# ---- alignment

def slow_codecs():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(AT[0])
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=AT[1])


def brute_alignment(data):
    t, sp = slow_codecs()
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in plain}
    for b in range(256):
        if b not in plain:
            alphabet[chr(256 + len(alphabet) - len(plain))] = b
    per_doc = []
    for doc_id, text, *_ in data:
        a = t.encode(" " + (text or ""), add_special_tokens=False)
        b = sp.encode(text or "")
        left = [(i, bytes(alphabet[c] for c in tok)) for i, tok in zip(a.ids, a.tokens)]
        right = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()) for i, p in ((i, sp.id_to_piece(i)) for i in b)]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
            per_doc.append((doc_id, [], [], [], ""))
            continue
        spans = []
        for side in (left, right):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, before = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if before <= s and e <= c) for side in spans) if len(cuts) < 400 else None)
            before = c
        per_doc.append((doc_id, spans[0], spans[1], links, groups))
    counts, best = Counter(), defaultdict(int)
    for *_, links, _g in per_doc:
        counts.update(set(links))
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (doc_id, len(a), len(b), len(g), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
         "" if not a else None if None in g else hashlib.sha256(";".join(g).encode()).hexdigest())
        for doc_id, a, b, links, g in per_doc
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(got, want):
    """Rows are equal; the digest of texts of many groups is not worked out by brute force."""
    key = lambda r: (r[0] is None, r[0] or 0, r[1:7])
    got, want = sorted(got, key=key), sorted(want, key=key)
    return [r[:7] for r in got] == [r[:7] for r in want] and all(w[7] is None or g[7] == w[7] for g, w in zip(got, want))


def test_alignment_edge_rows(spark, monkeypatch):
    data = rows() + [(900, "odd ▁ mark", "en", "s", 1), (901, "nul \x00 � é <s> </s> <unk>", "en", "s", 1), (902, "<|endoftext|>", "en", "s", 1), (903, " 　 x", "en", "s", 1)]
    want = brute_alignment(data)
    assert sum(r[1] == 0 for r in want) >= 4
    got = alignment.align(clashing(frame(spark, data)), *AT).select(*COLUMNS)
    assert same([tuple(r) for r in got.collect()], want)
    monkeypatch.setattr(alignment, "PASS_KEYS", 50)  # several ranges of first ids
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    assert same([tuple(r) for r in alignment.align(frame(spark, data), *AT).select(*COLUMNS).collect()], want)
    assert alignment.align(frame(spark, []), *AT).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    data = [(i, prose(30, i % 40) + f" {i}", "en", "s", 1) for i in range(120)]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    assert same([tuple(r) for r in QUERIES["op13_alignment"](spark, str(tmp_path)).select(*COLUMNS).collect()], brute_alignment(data))


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 200_000):
        keys = rng.choice(1 << 27, n, replace=False).astype(np.int64)
        sizes, maps = alignment.build(keys)
        one = alignment.Hash([0], [sizes], [maps])
        assert len(one) == n and np.array_equal(np.sort(one.places(keys)), np.arange(n))


def test_byte_level_ids_are_the_tokenizers():
    t, _ = slow_codecs()
    codecs = alignment.Codecs(*AT)
    for text in ["it's <|endoftext|> we'll", " " * 5000 + "x", "日本語 ñ \x1c\x00 𝒳", "a\n\n b\t\tc"]:
        (a, _b), = codecs.ids([text]) if "\x00" not in text else [(None, None)]
        if a is not None and len(a):
            assert a.tolist() == t.encode(" " + text, add_special_tokens=False).ids
