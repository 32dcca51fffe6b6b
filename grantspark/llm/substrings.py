"""Substring dedup by relative Lempel-Ziv parsing (operator 10).

Every document is a reference block for all others and itself. A block is indexed by its anchors: of each window of
``window`` words the run of ``gram`` words with the least hash, so equal windows have equal anchors at equal places. The
windows of one anchor follow each other; their words together are the anchor's context.

The parse of a document against all blocks copies greedily. An anchor whose whole context occurs elsewhere lies inside a
factor: all its windows are copies, settled by one count per context. An anchor that occurs elsewhere in other contexts lies
at a factor's boundary: there, and only there, every window is hashed from its exact words (128 bits) and looked up among
the windows of the same anchors. All consecutive known windows make a factor; none is shorter than ``window`` words. The
words of the factors are the duplicate spans, judged on the input.

Anchors, contexts and windows are counted with partial aggregation and joined by sort-merge joins, so a passage that a
third of all documents share is a large count and no large group; what comes together per document is no more than that document.

Marks meet their text by a 128-bit digest of it, so copies share their marks and nothing depends on the order of a scan.

A null text has no words. Texts shorter than the window keep everything. Repeated rows are documents of their own (each is a
copy of the other); ids may be null or repeat, as no id is used. Further columns are carried along, but for those named
like the added ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, query, release_worker_state, table, with_fields

#: Production parameters.
WINDOW_WORDS = 35
GRAM_WORDS = 6

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_FACTORS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def anchors_of(words: list[bytes], window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor: its first window, its number of windows, the hash of its words, the hash of its context."""
    from xxhash import xxh64_intdigest

    n = len(words)
    if n < window:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    grams = np.zeros(n - gram + 1, np.uint64)
    for i in range(gram):
        grams += h[i:n - gram + 1 + i] * _FACTORS[i]
    grams = _mixed(grams)
    at = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1).argmin(axis=1) + np.arange(n - window + 1)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.concatenate((first, [len(at)])))
    anchor = at[first]
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(powers), dtype=np.uint64)))
    unpowers = np.full(n, _UNBASE, np.uint64)
    unpowers[0] = 1
    context = (sums[first + count + window - 1] - sums[first]) * np.cumprod(unpowers)[first]
    context = _mixed(context + _FACTORS[0] * (anchor - first).astype(np.uint64) + _FACTORS[1] * count.astype(np.uint64))
    return first.astype(np.int32), count.astype(np.int32), grams[anchor], context


def window_hashes(words: list[bytes], starts: list[int], window: int = WINDOW_WORDS) -> list[bytes]:
    """128-bit hashes of the exact words of windows."""
    from xxhash import xxh3_128_digest

    line = b" ".join(words)
    begins = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)))
    at = np.asarray(starts, np.int64)
    return [xxh3_128_digest(line[a:b]) for a, b in zip(begins[at].tolist(), (begins[at + window] - 1).tolist())]


def covered(n: int, runs: list[tuple[int, int]], window: int = WINDOW_WORDS) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts in one of the runs (first start, number of starts)."""
    edges = np.zeros(n + 1, np.int64)
    for first, count in runs:
        edges[first] += 1
        edges[first + count - 1 + window] -= 1
    return np.cumsum(edges[:n]) > 0


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True as (start, stop)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _index(window: int, gram: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release_worker_state()
        # numbers rows so that a row's number plus a word offset is unique and in the rows' order
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, offsets, parts = [], [0], []
            for x in batch.column(1):
                words = x.as_buffer().to_pybytes().split() if x.is_valid else []
                found = anchors_of(words, window, gram)
                rows.append(number)
                number += len(words) + 1
                offsets.append(offsets[-1] + len(found[0]))
                parts.append(found)
            offsets = pa.array(offsets, pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([p[i] for p in parts]).view(kind) if parts else np.zeros(0, kind)))
                for i, kind in enumerate((np.int32, np.int32, np.int64, np.int64))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), batch.column(0), *lists], names=["row", "key", "first", "count", "anchor", "context"])

    return index


def _boundary(window: int):
    import zstandard

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_state()
        unpack, seen = zstandard.ZstdDecompressor().decompress, set()
        for batch in batches:
            for key, packed, marks in zip(*(batch.column(i) for i in range(3))):
                key = key.as_py()
                if key in seen:  # copies of a text
                    continue
                seen.add(key)
                starts = [i for m in marks.as_py() for i in range(m["first"], m["first"] + m["count"])]
                both = np.frombuffer(b"".join(window_hashes(unpack(packed.as_buffer()).split(), starts, window)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(starts), pa.binary()), pa.array(starts, pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
                    names=["key", "first", "h1", "h2"],
                )

    return hashes


def _stripped(window: int, others: int):
    import zstandard

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_state()
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for packed, marks in zip(batch.column(others), batch.column(others + 1)):
                body = unpack(packed.as_buffer()) if packed.is_valid else None
                words = body.split() if body else []
                sizes.append(len(words))
                if not marks.is_valid:
                    removed.append(0), spans.append([]), kept.append(body)
                    continue
                mask = covered(len(words), [(m["first"], m["count"]) for m in marks.as_py()], window)
                removed.append(int(mask.sum())), spans.append(spans_of(mask))
                kept.append(b" ".join(compress(words, (~mask).tolist())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:others], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names[:others], "n_words", "n_removed", "spans", "kept"],
            )

    return strip


@F.arrow_udf(T.BinaryType())
def _packed(column: pa.Array) -> pa.Array:
    import zstandard

    release_worker_state()
    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array([pack(x.as_buffer().to_pybytes()) if x.is_valid else None for x in column], pa.binary())


def dedup_substrings(docs: DataFrame, text_col: str = "text", window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """The other columns of ``docs`` with n_words, n_removed, spans (word offsets, stop excluded) and kept.

    ``kept`` is the text itself (null for null) where nothing is removed, else the words left, joined by one space.
    """
    others = [c for c in docs.columns if c != text_col and c not in ("n_words", "n_removed", "spans", "kept")]
    # names of our own, so that no column of the input clashes with what is worked out on the way
    carried = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)]
    body = F.col(f"`{text_col}`").cast("binary")
    key = F.unhex(F.md5(F.coalesce(body, F.lit("").cast("binary"))))
    texts = docs.select(*carried, key.alias("key"), body.alias("_body"))
    index = materialize(
        texts.select("key", "_body").mapInArrow(_index(window, gram), "row long, key binary, first array<int>, count array<int>, anchor array<long>, context array<long>"),
        "blocks",
    )
    # copies of a text have the same anchors and contexts, so its first row stands for it, and holds its boundary occurrences
    keys = materialize(index.filter(F.size("first") > 0).groupBy("key").agg(F.min("row").alias("row")), "keys")

    def by_text(places: DataFrame, name: str) -> DataFrame:
        """Places (row, first, count) as one list per text: a row's places are put together before the join."""
        return places.groupBy("row").agg(F.collect_list(F.struct("first", "count")).alias(name)).join(keys, "row").select("key", name)

    anchors = index.select("row", F.explode(F.arrays_zip("first", "count", "anchor", "context")).alias("a")).select("row", "a.*")
    shared = anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("least"), F.max("context").alias("most"))
    # stored, so that the join below has a shuffle on either side and adaptive execution can split a frequent anchor
    shared = materialize(shared.filter("n > 1").select("anchor", (F.col("least") < F.col("most")).alias("mixed")), "shared")
    repeated = materialize(anchors.join(shared, "anchor"), "repeated")
    contexts = materialize(
        repeated.groupBy("anchor", "context")
        .agg(F.count("*").alias("n"), F.max("mixed").alias("mixed"), F.min("row").alias("row"), F.min(F.col("row") + F.col("first")).alias("place"), F.min("count").alias("count"))
        .filter("n > 1 OR mixed"), "contexts",
    )
    inside = repeated.join(contexts.filter("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").select("row", "first", "count")
    # one occurrence stands for all of a context; those of contexts with several are known and only serve as a reference
    boundary = contexts.filter("mixed").select("row", (F.col("place") - F.col("row")).cast("int").alias("first"), "count")
    looked_up = by_text(boundary, "marks")
    windows = materialize(
        texts.select("key", _packed("_body").alias("_packed")).join(looked_up, "key").mapInArrow(_boundary(window), "key binary, first int, h1 long, h2 long"), "windows"
    )
    twice = materialize(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2"), "twice")
    outside = windows.join(twice, ["h1", "h2"], "left_semi").select("key", "first", F.lit(1).alias("count"))
    outside = outside.groupBy("key").agg(F.collect_list(F.struct("first", "count")).alias("marks"))
    marks = by_text(inside, "marks").union(outside).groupBy("key").agg(F.flatten(F.collect_list("marks")).alias("_marks"))
    places = [f"_{i}" for i in range(len(others))]
    found = texts.select(*places, "key", _packed("_body").alias("_packed")).join(marks, "key", "left").select(*places, "_packed", "_marks")
    return found.mapInArrow(
        _stripped(window, len(others)),
        with_fields(T.StructType(list(found.schema)[:len(others)]), "n_words long, n_removed long, spans array<struct<start:int,stop:int>>, kept string"),
    ).toDF(*others, "n_words", "n_removed", "spans", "kept")


@query("op10_substrings")
def op10_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    # unchanged texts still hold their own white space
    words = F.trim(F.regexp_replace(F.coalesce("kept", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))
