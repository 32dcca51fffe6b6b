"""Tokens, packing, fingerprints, media and substrings against brute force."""

from __future__ import annotations

import hashlib
import io
import random
import tarfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grantspark.llm import bpe, media, packing, simhash, substrings
from grantspark.llm.common import materialize, shared_dir

from .cases import clashing, frame, prose, rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# ---- byte-level BPE

def reference_ids(text: str) -> list[int]:
    """Each match of the pattern encoded alone."""
    import regex

    enc = bpe.codec(RANKS, public_tokenizers.PATTERN)
    return [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in enc._encode_single_piece(m)]


def test_encode_and_decode_edge_rows(spark):
    df = bpe.decode(bpe.encode(clashing(frame(spark)), RANKS, public_tokenizers.PATTERN, part_chars=64), RANKS, public_tokenizers.PATTERN)
    got = Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in df.collect())
    want = Counter((r[0], np.array(reference_ids(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode()) for r in rows())
    assert got == want
    assert bpe.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 400_000 + "x", "ab'sx 12ab!! \n\n \t x" * 900, "日本" * 9000, "\n" * 3000])
def test_safe_parts_change_no_ids(text):
    enc = bpe.codec(RANKS, public_tokenizers.PATTERN)
    assert "".join(bpe.safe_parts(text, 500)) == text
    assert bpe.encode_text(enc, text, 500) == np.array(reference_ids(text), "<u4").tobytes()


# ---- packing

def tokenizer_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]


def test_chunked_ids_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 50)
    codec = packing.ChunkIds(TOKENIZER)
    texts = [r[1] or "" for r in rows()] + [prose(50, s) for s in range(8)]
    for _ in range(2):
        for i in range(0, len(texts), 3):
            got = [np.frombuffer(b, "<u4").tolist() for b in codec.texts(texts[i:i + 3], b"\0" * 4)]
            assert got == tokenizer_ids(texts[i:i + 3])


@pytest.mark.parametrize("seed", range(4))
def test_ids_of_texts_cut_at_match_starts(seed, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 400)
    rng = random.Random(seed)
    signs = [*" '\n\t\r\x0b\x0c\x1c\x00\x7f\x85\xa0\u1680\u180e\u2003\u2028\u3000abZst90.,!-(%²é×÷ßÇɏЀ\u0482Α;東あ\u0301😀«¡º", *[" "] * 6, "'s", "'ll", "\n\n", "the"]
    texts = ["".join(rng.choices(signs, k=rng.choice((0, 1, 2, 4, 12, 40)))) for _ in range(1500)]
    codec = packing.ChunkIds(TOKENIZER)
    assert [np.frombuffer(b, "<u4").tolist() for b in codec.texts(texts, b"\0" * 4)] == tokenizer_ids(texts)


def test_known_words_are_not_tokenized_again():
    codec = packing.ChunkIds(TOKENIZER)
    codec.texts(["Grün field field grün, Field\nfield, (field) 12 - \nGrün\nField"], b"")
    given, library = [], codec.tokenizer

    class Counted:
        def encode_batch_fast(self, parts, **how):
            given.extend(parts)
            return library.encode_batch_fast(parts, **how)

    codec.tokenizer = Counted()
    texts = ["Grün grün,\nField field\nGrün,\nfield Field\nfield\nGrün", "field\nField,\nfield field,\nField 12"]
    assert [np.frombuffer(b, "<u4").tolist() for b in codec.texts(texts, b"\0" * 4)] == tokenizer_ids(texts)
    assert given == []


def test_pack_edge_rows(spark):
    cap = 64
    pieces = packing.pack(packing.cut(packing.tokenize(clashing(frame(spark)), TOKENIZER), cap), cap).collect()
    by_text = Counter()
    seqs = defaultdict(list)
    docs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length
        docs[p.doc_id].append(p)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    data = rows()
    want = {i: ids for (i, *_), ids in zip(data, tokenizer_ids([r[1] or "" for r in data]))}
    for i, parts in docs.items():
        if i in (None, 7):  # rows that share an id
            continue
        parts.sort(key=lambda p: p.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist() == want[i]
        assert all(p.length == cap for p in parts[1:]) and [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
    assert len(docs[7]) % 2 == 0 and not by_text
    assert packing.pack(packing.cut(packing.tokenize(frame(spark, []), TOKENIZER))).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_whole_and_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    cap = 256
    counts = np.bincount(np.minimum(cap, 1 + rng.geometric(0.02, 3000)), minlength=cap + 1)
    plan = packing.solve(counts, cap)
    held = np.zeros(cap + 1, int)
    for filling, often in plan:
        assert sum(s * a for s, a in filling) <= cap
        for s, a in filling:
            held[s] += a * often
    assert (held == counts).all()
    bins = sum(often for _, often in plan)
    assert bins <= sum(packing.best_fit(counts, cap).values())
    assert bins <= 1.01 * -(-int((counts * np.arange(cap + 1)).sum()) // cap) + 1


def test_plan_of_a_huge_corpus_is_small_and_whole():
    rng = np.random.default_rng(9)
    cap = 256
    counts = np.zeros(cap + 1, int)
    counts[1:] = rng.integers(0, 10**9, cap)
    plan = packing.solve(counts, cap)
    held = np.zeros(cap + 1, int)
    for filling, often in plan:
        for s, a in filling:
            held[s] += a * often
    assert (held == counts).all() and len(plan) < 100_000


def test_program_beats_best_fit_where_that_wastes():
    counts = np.zeros(101, int)
    counts[[45, 30, 25, 34, 33, 23]] = 300, 300, 600, 400, 800, 200
    assert sum(n for _, n in packing.solve(counts, 100)) <= sum(packing.best_fit(counts, 100).values())


def test_knapsack_table_is_optimal():
    value = np.zeros(31)
    value[[3, 7, 11]] = 4.0, 10.5, 17.0
    best, _ = packing.best_fillings(value, 30)
    brute = max(4 * a + 10.5 * b + 17 * c for a in range(11) for b in range(5) for c in range(3) if 3 * a + 7 * b + 11 * c <= 30)
    assert best[30] == brute


# ---- SimHash

def slow_fingerprint(text: str) -> int:
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[tuple]) -> dict[int, object]:
    parent = {f: f for _, f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = list(parent)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {f: least.get(find(f)) for f in keys}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover(radius):
    import itertools

    kept = simhash.masks(radius)
    assert len(kept) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(0, 64, 3), radius):
        assert any(all(not m >> b & 1 for b in bits) for m in kept)


def test_fingerprints_and_components_edge_rows(spark):
    data = rows()
    docs = materialize(clashing(frame(spark)).select("doc_id", simhash.fingerprint(F.col("text"))), "fp")
    got = Counter((r.doc_id, r.fingerprint & (1 << 64) - 1) for r in docs.collect())
    want = [(r[0], slow_fingerprint(r[1])) for r in data]
    assert got == Counter(want)
    component = brute_components(want)
    found = {r.fingerprint & (1 << 64) - 1: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert found == component


def test_links_of_crowded_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    prints = {base}
    for _ in range(300):
        f = base
        for b in rng.integers(0, 64, int(rng.integers(0, 6))):
            f ^= 1 << int(b)
        prints.add(f)
    prints = [(i, f) for i, f in enumerate(sorted(prints))]
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in prints], "doc_id long, fingerprint long")
    found = {r.fingerprint & (1 << 64) - 1: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert found == brute_components(prints)


def test_keep_one_keeps_one_row_per_component(spark):
    data = rows()
    kept = simhash.keep_one(clashing(frame(spark)))
    assert kept.columns == clashing(frame(spark)).columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    component = brute_components([(r[0], slow_fingerprint(r[1])) for r in data])
    assert len(got) == len({c if c is not None else ("null", f) for f, c in component.items()})
    assert simhash.keep_one(frame(spark, [])).count() == 0


# ---- media

def test_media_round_trip_and_shards(spark):
    folder = f"{shared_dir(spark)}/media-test-{hashlib.sha256(str(id(spark)).encode()).hexdigest()[:8]}"
    index = materialize(media.write_shards(clashing(frame(spark)).repartition(3), folder), "media-test")
    places = media.probe(media.locate(index), folder)
    read = {r.digest: r for r in media.read_media(places, folder).collect()}
    seen = Counter()
    for r in index.collect():
        seen[(r.doc_id, r.n_bytes)] += 1
        x = read[r.digest]
        assert x.media_sha256 == r.digest and (x.bit_depth, x.colour_type, x.width) == (8, 0, 64)
    assert seen == Counter((d, len((t or "").encode())) for d, t, *_ in rows())
    payloads = {hashlib.sha256(media.payload_of((t or "").encode())).hexdigest() for _, t, *_ in rows()}
    assert {x.payload_sha256 for x in read.values()} == payloads
    # the shards are ordinary tar files
    store, root = media._open(folder)
    from pyarrow import fs

    members = [m for f in store.get_file_info(fs.FileSelector(root)) for m in tarfile.open(fileobj=io.BytesIO(store.open_input_file(f.path).read())).getnames()]
    assert {m.removesuffix(".png") for m in members} == set(read)
    assert media.write_shards(frame(spark, []), folder).count() == 0


def test_png_is_exact():
    payload = media.payload_of(bytes(range(256)) * 3 + b"x")
    png = media.encode_png(payload)
    assert media.decode_png(png) == payload and media.header_of(png[:33])[:2] == (64, len(payload) // 64)
    assert zlib.crc32(media.payload_of(b"")[-64:]) == zlib.crc32(bytes(64))
    assert len(media.feature_of(payload)) == 16


# ---- substrings

def brute_strip(texts: list[str], window: int = 35):
    words = [(t or "").encode().split() for t in texts]
    starts = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        mask = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i:i + window])] > 1:
                mask[i:i + window] = [True] * window
        out.append((len(w), sum(mask), b" ".join(x for x, m in zip(w, mask) if not m).decode()))
    return out


def stripped(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, " ".join((r.kept or "").encode().decode().split()) if not r.n_removed else r.kept) for r in df.collect())


def test_substrings_edge_rows(spark):
    data = rows()
    got = Counter((r.doc_id, r.n_words, r.n_removed, b" ".join((r.kept or "").encode().split())) for r in substrings.dedup_substrings(clashing(frame(spark))).collect())
    want = Counter((r[0], n, m, k.encode()) for r, (n, m, k) in zip(data, brute_strip([r[1] for r in data])))
    assert got == want
    assert substrings.dedup_substrings(frame(spark, [])).count() == 0


def test_passages_at_every_offset_and_length(spark):
    passage = prose(120, 50).split()
    data = []
    for k, (a, b) in enumerate([(0, 120), (0, 35), (1, 36), (10, 44), (50, 120), (85, 120), (86, 120), (20, 90), (60, 95)]):
        data.append((k, " ".join([prose(k + 1, 60 + k), *passage[a:b], prose(40, 80 + k)]), None, None, None))
    data.append((99, prose(3, 7) + " ab" * 90, None, None, None))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(frame(spark, data)).collect())
    assert got == Counter((r[0], *x) for r, x in zip(data, brute_strip([r[1] for r in data])))
