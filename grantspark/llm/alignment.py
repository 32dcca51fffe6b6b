"""Cross-tokenizer alignment with corpus counts under a minimal perfect hash (operator 13).

Two tokenizations of one text are laid over its bytes. Where tokens of both end, the text is cut into groups; every stretch between two
token ends, of either side, links one token of each. The ids are stored once, as short integers.

The first pass aligns all documents and keeps, per task, in how many documents each pair of ids is linked. The distinct pairs are dealt out by
their first id's high bits; of each such shard a task builds a minimal perfect hash (a cascade of bit maps: a key that has its place in a
map to itself stays, the others go on to the next). Each task's counts become dense vectors indexed by that hash, and the vectors are
summed in a tree of bounded width. The second pass aligns the stored ids again and looks every link up; a place holds its key, so a
foreign pair would be an error and not a wrong count.

What a lookup task holds is bounded by ``PASS_KEYS``: if there are more pairs, the first ids are split into ranges and the second pass runs once
per range, each adding its links. A pair's rivals share its first id, so a range never misses one.

Texts that are null, empty, or not restored byte by byte by both tokenizers have no tokens: zeros and an empty string. Repeated rows
count as documents of their own; null and repeated ids do no harm. Only the two named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_text
from .common import materialize, query, release_worker_state, table, texts_of, vocabulary_path, worker_state

#: Bits of a second id in a key, of a first id inside its shard, and of a document inside a run.
ID_BITS, SHARD_BITS, RUN_BITS = 20, 8, 23
#: Vectors that one task sums at a time, and keys that one lookup task holds.
FAN_IN, PASS_KEYS = 32, 1 << 23
#: Bytes of text aligned at once.
RUN_BYTES = 8 << 20
#: Bit map places per key, and maps at most (far more than ever needed: two thirds of the keys stay in each).
ROOM, LEVELS = 2.0, 64


# ---- tokens ---------------------------------------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codecs:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, byte_level: str, pieces: str, pattern: str) -> None:
        import sentencepiece
        import tiktoken

        with open(byte_level, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, special = byte_alphabet(), {t["content"] for t in spec["added_tokens"]}
        # a byte-level vocabulary numbers its entries in the order of their merges, so ids are ranks
        ranks = {bytes(map(alphabet.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]

        self.a_len, self.b_len = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    def ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of either side, empty where a text is empty or not restored."""
        none = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = np.frombuffer(encode_text(self.a, " " + text), "<u4") if text else none[0]
            raw = (" " + text).encode()
            whole = text and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            yield (a, np.array(b, np.uint32)) if whole else none


def _codecs(at: tuple[str, str, str]) -> Codecs:
    return worker_state(("alignment", *at), lambda: Codecs(*at))


def tokenize(docs: DataFrame, at: tuple[str, str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, a, b): little-endian unsigned 16-bit ids of both tokenizations (32-bit where a vocabulary needs them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = _codecs(at)
        kinds = [_kind(len(x)) for x in (codecs.a_bytes, codecs.b_bytes)]
        for batch in batches:
            start = 0
            for texts in texts_of(batch.column(2), 2 << 20):
                both = list(codecs.ids(texts))
                sides = [pa.array([p[k].astype(kinds[k]).tobytes() for p in both], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*(c.slice(start, len(texts)) for c in batch.columns[:2]), *sides], names=["row", "id", "a", "b"])
                start += len(texts)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"row long, id {kind}, a binary, b binary")


def _kind(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


# ---- alignment ------------------------------------------------------------------------------------------------

class Aligned:
    """A run of documents laid end to end: ``key`` and ``doc`` of every link, ``a_group``, ``b_group`` of every token."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_len: np.ndarray, b_len: np.ndarray) -> None:
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (a, b))
        a_end, b_end = np.cumsum(a_len[self.a]), np.cumsum(b_len[self.b])
        total = int(a_end[-1]) if len(a_end) else 0
        at_a, at_b = np.zeros(total, bool), np.zeros(total, bool)
        at_a[a_end - 1], at_b[b_end - 1] = True, True
        cut, ends = at_a & at_b, np.flatnonzero(at_a | at_b)
        before = np.cumsum(cut) - cut
        self.a_group, self.b_group = before[a_end - 1], before[b_end - 1]
        # the tokens that a stretch belongs to are those not ended before its last byte
        i, j = (np.cumsum(at) - at for at in (at_a, at_b))
        self.key = self.a[i[ends]] << ID_BITS | self.b[j[ends]]
        stops = np.concatenate(([0], a_end))[np.cumsum(self.n_a)]
        upto = np.concatenate(([0], np.cumsum(at_a | at_b)))[stops]
        groups = np.concatenate(([0], np.cumsum(cut)))[stops]
        self.n_links, self.n_groups = np.diff(upto, prepend=0), np.diff(groups, prepend=0)
        self.doc = np.repeat(np.arange(len(a)), self.n_links)

    def group_digests(self, words: list[bytes]) -> list[str]:
        """sha256 of each document's groups; ``words`` holds ids with the mark after them (see ``marked``), empty documents ''."""
        n = len(words) // 4
        last_a = np.concatenate((self.a_group[1:] != self.a_group[:-1], [True]))[:len(self.a)]
        last_b = np.concatenate((self.b_group[1:] != self.b_group[:-1], [True]))[:len(self.b)]
        count_a, count_b = (np.bincount(g, minlength=int(self.n_groups.sum())) for g in (self.a_group, self.b_group))
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + (np.cumsum(count_b) - count_b)[self.a_group]] = self.a + n * last_a
        order[np.arange(len(self.b)) + np.cumsum(count_a)[self.b_group]] = self.b + n * (2 + last_b)
        found, start, of = [], 0, words.__getitem__
        for stop in np.cumsum(self.n_a + self.n_b).tolist():
            found.append(hashlib.sha256(b"".join(map(of, order[start:stop].tolist()))[:-1]).hexdigest() if stop > start else "")
            start = stop
        return found


def marked(n: int) -> list[bytes]:
    """Decimal ids below ``n`` with a mark: inside and at the end of a group's first side, then of its second."""
    return [b"%d%s" % (i, mark) for mark in (b",", b"|", b",", b";") for i in range(n)]


def _runs(batch: pa.RecordBatch, codecs: Codecs) -> Iterator[tuple[int, Aligned]]:
    """(first row, alignment) of runs of a batch (.., a, b) of about RUN_BYTES."""
    kinds = [_kind(len(x)) for x in (codecs.a_bytes, codecs.b_bytes)]
    a, b = ([np.frombuffer(x.as_buffer(), k) for x in batch.column(c)] for c, k in zip(("a", "b"), kinds))
    start, held = 0, 0
    for i in range(len(a)):
        held += 4 * len(a[i])
        if held > RUN_BYTES or i + 1 == len(a):
            yield start, Aligned(a[start:i + 1], b[start:i + 1], codecs.a_len, codecs.b_len)
            start, held = i + 1, 0


# ---- minimal perfect hash -------------------------------------------------------------------------------------

def _spread(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (keys.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes in 64-bit words of the cascade's maps, and the maps one after the other, of distinct keys."""
    sizes, maps = [], []
    while len(keys):
        if len(sizes) == LEVELS:
            raise ValueError("keys repeat")
        size = max(1, int(-(-len(keys) * ROOM // 64)))
        at = (_spread(keys, len(sizes)) % np.uint64(64 * size)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * size) == 1
        sizes.append(size)
        maps.append(np.packbits(alone, bitorder="little").view("<u8"))
        keys = keys[~alone[at]]
    return sizes, np.concatenate([np.zeros(0, "<u8"), *maps])


class Hash:
    """The cascades of all shards together: every key has its own place among ``len(self)``."""

    def __init__(self, shards: list[int], sizes: list[list[int]], maps: list[np.ndarray]) -> None:
        deepest = max(map(len, sizes), default=0)
        n = max(shards, default=-1) + 1
        self.size, self.start = np.zeros((deepest, n), np.int64), np.zeros((deepest, n), np.int64)
        at = 0
        for shard, own in zip(shards, sizes):
            for level, size in enumerate(own):
                self.size[level, shard], self.start[level, shard] = size, at
                at += size
        self.map = np.concatenate([np.zeros(0, "<u8"), *maps])
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.map), dtype=np.int64)))

    def __len__(self) -> int:
        return int(self.before[-1])

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys; of a foreign key any place or -1."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        shard = keys >> (ID_BITS + SHARD_BITS)
        known = shard < self.size.shape[1]
        open_ = open_[known]
        for level in range(len(self.size)):
            own = shard[open_]
            open_ = open_[self.size[level, own] > 0]
            own = shard[open_]
            bit = (_spread(keys[open_], level) % (64 * self.size[level, own]).astype(np.uint64)).astype(np.int64)
            word, bit = self.start[level, own] + (bit >> 6), (bit & 63).astype(np.uint64)
            here = self.map[word]
            hit = (here >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(here[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            found[open_[hit]] = self.before[word[hit]] + below
            open_ = open_[~hit]
        return found


# ---- counts ---------------------------------------------------------------------------------------------------

def _task_counts(at: tuple[str, str, str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codecs, task = _codecs(at), TaskContext.get().partitionId()
        keys, counts, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def merged():
            every = np.concatenate([keys, *(k for k, _ in waiting)])
            sums, where = np.unique(every, return_inverse=True)
            return sums, np.bincount(where, np.concatenate([counts, *(n for _, n in waiting)]), len(sums)).astype(np.int64)

        for batch in batches:
            for _, run in _runs(batch, codecs):
                once = np.unique(run.key << RUN_BITS | run.doc) >> RUN_BITS
                first = np.flatnonzero(np.concatenate(([True], once[1:] != once[:-1]))) if len(once) else np.zeros(0, np.int64)
                waiting.append((once[first], np.diff(first, append=len(once))))
                if sum(len(k) for k, _ in waiting) > max(1 << 20, len(keys)):
                    keys, counts = merged()
                    waiting = []
        keys, counts = merged()
        shard = keys >> (ID_BITS + SHARD_BITS)
        cuts = [*np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))).tolist(), len(shard)] if len(shard) else [0]
        for x, y in zip(cuts, cuts[1:]):
            yield pa.RecordBatch.from_arrays([
                pa.array([task], pa.int64()), pa.array([int(shard[x])], pa.int64()),
                pa.array([keys[x:y].tolist()], pa.list_(pa.int64())), pa.array([counts[x:y].tolist()], pa.list_(pa.int64())),
            ], names=["task", "shard", "keys", "counts"])

    return count


def _functions(group: pa.Table) -> pa.Table:
    keys = group["key"].to_numpy()
    sizes, maps = build(keys)
    one = Hash([int(keys[0] >> (ID_BITS + SHARD_BITS))], [sizes], [maps])
    placed = np.empty(len(keys), np.int64)
    placed[one.places(keys)] = keys
    return pa.table({"shard": pa.array([int(group["shard"][0].as_py())], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())), "maps": pa.array([maps.tobytes()], pa.binary()),
                     "placed": pa.array([placed.tobytes()], pa.binary())})


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of a shard as a vector with a number per place."""
    release_worker_state()
    for batch in batches:
        vectors = []
        for shard, keys, counts, sizes, maps in zip(*(batch.column(c) for c in ("shard", "keys", "counts", "sizes", "maps"))):
            one = Hash([shard.as_py()], [sizes.as_py()], [np.frombuffer(maps.as_buffer(), "<u8")])
            vector = np.zeros(len(one), np.int64)
            vector[one.places(keys.values.to_numpy())] = counts.values.to_numpy()
            vectors.append(vector.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("task"), pa.array(vectors, pa.binary())], names=["shard", "task", "vector"])


def _summed(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_buffer(), np.int64) for v in group["vector"])
    return pa.table({"shard": group["shard"].slice(0, 1), "task": group["task"].slice(0, 1), "vector": pa.array([total.tobytes()], pa.binary())})


def pair_counts(tokens: DataFrame, at: tuple[str, str, str]) -> DataFrame:
    """(shard, sizes, maps, placed, vector, n): each shard's hash, the key and the number of documents at each of its places."""
    partial = materialize(tokens.select("a", "b").mapInArrow(_task_counts(at), "task long, shard long, keys array<long>, counts array<long>"), "partial")
    keys = partial.select("shard", F.explode("keys").alias("key")).groupBy("shard", "key").agg(F.lit(1).alias("_"))
    functions = materialize(keys.select("shard", "key").groupBy("shard").applyInArrow(_functions, "shard long, sizes array<long>, maps binary, placed binary"), "hashes")
    vectors = materialize(partial.join(functions.drop("placed"), "shard").mapInArrow(_dense, "shard long, task long, vector binary"), "vectors")
    tasks = vectors.agg(F.max("task")).first()[0] or 0
    while True:
        level = vectors.select("shard", F.floor(F.col("task") / FAN_IN).alias("task"), "vector")
        vectors = materialize(level.groupBy("shard", "task").applyInArrow(_summed, "shard long, task long, vector binary"), "vectors")
        tasks //= FAN_IN
        if tasks == 0:
            break
    return functions.join(vectors.drop("task"), "shard").withColumn("n", F.octet_length("placed") / 8)


def _lookup(at: tuple[str, str, str], shared, whole: bool):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = _codecs(at)
        hashed, placed, counts, best, low, high = shared.value
        words = marked(max(len(codecs.a_bytes), len(codecs.b_bytes))) if whole else []
        for batch in batches:
            for start, run in _runs(batch, codecs):
                ours = slice(None) if whole and low == 0 and high is None else (run.key >> ID_BITS >= low) & (True if high is None else run.key >> ID_BITS < high)
                link, doc, docs = run.key[ours], run.doc[ours], len(run.n_a)
                keys, where = np.unique(link, return_inverse=True)
                place = hashed.places(keys)
                if len(keys) and not np.array_equal(placed[place], keys):
                    raise ValueError("a pair of ids that was not counted")
                n = counts[place][where] if len(keys) else np.zeros(0, np.int64)
                sums = [np.bincount(doc, n == best[link >> ID_BITS], docs).astype(np.int64), _sums(doc, n, docs)]
                rest = [run.n_a, run.n_b, run.n_groups, run.n_links] if whole else []
                digests = [pa.array(run.group_digests(words))] if whole else []
                names = ["row", "id"] * whole + ["row"] * (not whole) + ["n_a", "n_b", "n_groups", "n_links"] * whole + ["n_best", "count_sum"] + ["groups_sha256"] * whole
                carried = [batch.column(c).slice(start, docs) for c in (("row", "id") if whole else ("row",))]
                yield pa.RecordBatch.from_arrays([*carried, *(pa.array(x, pa.int64()) for x in (*rest, *sums)), *digests], names=names)

    return look_up


def _sums(doc: np.ndarray, n: np.ndarray, docs: int) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
    return np.diff(upto[np.searchsorted(doc, np.arange(docs), "right")], prepend=0)


def _ranges(sizes: list[tuple[int, int]]) -> list[list[int]]:
    """Neighbouring shards with at most PASS_KEYS keys together (a shard alone may have more)."""
    runs, held = [[]], 0
    for shard, n in sizes:
        if runs[-1] and held + n > PASS_KEYS:
            runs.append([])
            held = 0
        runs[-1].append(shard)
        held += n
    return runs


def align(docs: DataFrame, byte_level: str, pieces: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``."""
    at, spark = (byte_level, pieces, pattern), docs.sparkSession
    tokens = materialize(tokenize(docs, at, id_col, text_col), "tokens")
    counted = materialize(pair_counts(tokens, at), "counted")
    kind = docs.schema[id_col].dataType.simpleString()
    runs = _ranges([(r.shard, int(r.n)) for r in counted.select("shard", "n").orderBy("shard").collect()])  # a row per 256 first ids
    found = None
    for number, shards in enumerate(runs):
        held = counted.filter(F.col("shard").between(shards[0], shards[-1]) if shards else F.lit(False)).orderBy("shard").toArrow()
        hashed = Hash(held["shard"].to_pylist(), held["sizes"].to_pylist(), [np.frombuffer(x.as_buffer(), "<u8") for x in held["maps"]])
        placed, counts = (np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x.as_buffer(), np.int64) for x in held[c])]) for c in ("placed", "vector"))
        low = 0 if number == 0 else shards[0] << SHARD_BITS
        high = runs[number + 1][0] << SHARD_BITS if number + 1 < len(runs) else None
        best = np.zeros(int(placed.max() >> ID_BITS) + 1 if len(placed) else 1, np.int64)
        np.maximum.at(best, placed >> ID_BITS, counts)
        shared = spark.sparkContext.broadcast((hashed, placed, counts, best, low, high))
        if number == 0:
            schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
            found = tokens.mapInArrow(_lookup(at, shared, True), schema)
        else:
            more = tokens.select("row", "a", "b").mapInArrow(_lookup(at, shared, False), "row long, n_best long, count_sum long")
            more = more.select("row", F.col("n_best").alias("_best"), F.col("count_sum").alias("_sum"))
            found = found.join(more, "row").withColumns({"n_best": F.col("n_best") + F.col("_best"), "count_sum": F.col("count_sum") + F.col("_sum")}).drop("_best", "_sum")
    return found.drop("row").withColumnRenamed("id", id_col)


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return align(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
