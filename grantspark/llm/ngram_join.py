"""N-gram Jaccard join by groups of equal prefixes, complete and exact (operator 11).

A document is the set of its word shingles. All sets are put in one order of all shingles; two sets of similarity ``t`` or more share one
shingle among the first ``n - ceil(t n) + 1`` of either. The order is by hash, with crowded shingles last. A shingle is crowded
if more than CROWDED distinct sets hold it in their sketch, a prefix of twice that length by hash alone, or if so many of the sets whose sketch
is crowded hold it at all; these counts cover all documents. So a passage that many documents hold brings no two of them together. The order changes the cost, never the result.

Equal sets are one node, and nodes with the same prefix and size are one group. Groups meet in buckets, one per shingle of a prefix. In a bucket of at most CROWDED groups all
of them do; pairs of groups are filtered by sizes and by how many prefix shingles they share, then expanded to their members, which are
verified on whole sets. Buckets that are still crowded hold sets of crowded shingles only, such as large families of copies. There a few
central groups meet the others, and only where a bucket still holds different components are pairs made, of groups that have the shingle early
(of two similar sets the smaller one has the first shared shingle among its first ``(1 - 2t/(1+t)) n``) with larger ones.

Verification goes in two rounds: each group's likeliest partner, the central ones of each crowd and every group's first member come first; of all
other pairs only those that are not connected by then.

Rows with null text, empty text or no word have an empty set and no link, unless ``link_empty`` makes them one class. A text of fewer words than a
shingle is one shingle. Repeated rows and null ids are kept; a component's id is its least id that is not null. Only the two named columns are read.
The rows are read several times and must come in the same order each time, as those of a stored table do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, materialize, query, release_worker_state, table
from .components import components

#: Production parameters of the query: words of a shingle, least similarity as a fraction.
SHINGLE_WORDS = 4
SIMILARITY = (85, 100)
#: What orders the shingles, results do not depend on it: holders that make one crowded, and how many such are known at most.
CROWDED = 48
KNOWN = 1 << 20
#: Groups of a crowded bucket that all its others are compared with first.
CENTRES = 4
_FACTORS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], np.uint64)


# ---- sets -----------------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes; ``lower`` and ``split`` of bytes know A-Z and \\x20\\x09-\\x0D only."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    m = max(1, n - k + 1)
    sums = np.full(m, min(n, k), np.uint64)
    for i in range(min(n, k)):
        sums += _mixed(h[i:i + m] ^ _FACTORS[i])
    return np.unique(_mixed(sums))


def prefix_size(n: int, similarity: tuple[int, int]) -> int:
    num, den = similarity
    return n - -(-n * num // den) + 1 if n else 0


def _bytes(x) -> bytes:
    return x.as_buffer().to_pybytes() if x.is_valid else b""


def _name(values: np.ndarray, seed: int = 0) -> int:
    """A signed 64-bit name of a sequence of hashes."""
    from xxhash import xxh64_intdigest

    x = xxh64_intdigest(values.tobytes(), seed)
    return x - (1 << 64) if x >= 1 << 63 else x


def _sketches(k: int, similarity: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_state()
        for batch in batches:
            sets = [shingles(_bytes(x), k) for x in batch.column(2)]
            sketch = [s[:2 * prefix_size(len(s), similarity)].view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array([_name(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _lists(sketch),
            ], names=["row", "id", "node", "size", "sketch"])

    return run


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def _ordered(s: np.ndarray, crowded: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """Hashes with the crowded ones last, by holders and hash; and how many of them are not crowded."""
    known, holders = crowded
    at = np.minimum(np.searchsorted(known, s), max(0, len(known) - 1))
    rank = np.where(known[at] == s, holders[at], 0) if len(known) else np.zeros(len(s), np.int64)
    return s[np.argsort(rank, kind="stable")], int((rank == 0).sum())


def _prefixes(crowded, similarity):
    """(node, size, prefix, ready, grp) of (node, size, sketch or whole set).

    A sketch does not always settle the prefix: then ``ready`` is false.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_state()
        for batch in batches:
            out, ready, names = [], [], []
            for n, x in zip(batch.column(1).to_pylist(), batch.column(2)):
                need = prefix_size(n, similarity)
                s, plain = _ordered(np.sort(x.values.to_numpy().view(np.uint64)), crowded)
                ready.append(plain >= need or len(s) == n)
                out.append(s[:need].view(np.int64) if ready[-1] else np.zeros(0, np.int64))
                names.append(_name(out[-1], n + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _lists(out), pa.array(ready, pa.bool_()), pa.array(names, pa.int64())], names=["node", "size", "prefix", "ready", "grp"])

    return run


def _crowded(tables: list[DataFrame]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of the shingles with the most holders in any of the tables (node, size, shingles), and the holders."""
    every = None
    for t in tables:
        held = t.select(F.explode(F.col(t.columns[2])).alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED)
        every = held if every is None else every.union(held)
    known = every.groupBy("shingle").agg(F.max("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(KNOWN).toArrow()
    hashes = known["shingle"].to_numpy().view(np.uint64)
    by_hash = np.argsort(hashes)
    return hashes[by_hash], known["n"].to_numpy()[by_hash].astype(np.int64)


_PREFIX = "node long, size long, prefix array<long>, ready boolean, grp long"


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))


# ---- pairs ----------------------------------------------------------------------------------------------------

class Join:
    """The stages of one join; ``rows`` holds (row, id, node, size) of every row, ``links`` the verified pairs of nodes."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, similarity: tuple[int, int]) -> None:
        self.k, self.similarity = k, similarity
        self.texts = _numbered(docs, id_col, text_col)
        kind = docs.schema[id_col].dataType.simpleString()
        read = materialize(self.texts.mapInArrow(_sketches(k, similarity), f"row long, id {kind}, node long, size long, sketch array<long>"), "sketches")
        self.rows = materialize(read.drop("sketch"), "rows")
        first = self.rows.filter("size > 0").groupBy("node").agg(F.min("row").alias("row"))
        # a node's row, in which its text is found again
        self.nodes = materialize(read.join(first.select("row"), "row", "left_semi").select("node", "row", "size", "sketch"), "nodes")
        forget(read)

    def members(self) -> DataFrame:
        """(node, size, prefix, grp) of every node, the prefix in the order of all shingles."""
        sketches = self.nodes.select("node", "size", "sketch")
        by_sketch = _crowded([sketches])
        # sets that are crowded so far into their sketch are looked at as a whole, and so are their shingles' holders
        deep = materialize(sketches.mapInArrow(_prefixes(by_sketch, self.similarity), _PREFIX).filter("NOT ready").select("node"), "deep")
        whole = materialize(self._whole(deep), "whole")
        crowded = _crowded([sketches, whole])
        known = sketches.join(deep, "node", "left_anti").union(whole)
        short = materialize(known.mapInArrow(_prefixes(crowded, self.similarity), _PREFIX), "prefixes")
        rest = materialize(self._whole(short.filter("NOT ready").select("node")).mapInArrow(_prefixes(crowded, self.similarity), _PREFIX), "prefixes")
        forget(whole)
        return short.filter("ready").union(rest).drop("ready")

    def _whole(self, wanted: DataFrame) -> DataFrame:
        """(node, size, set) of nodes in a table (node)."""
        k = self.k

        @F.arrow_udf("array<long>")
        def whole(column: pa.Array) -> pa.Array:
            release_worker_state()
            return _lists([shingles(_bytes(x), k).view(np.int64) for x in column])

        wanted = self.nodes.select("node", "row", "size").join(wanted, "node", "left_semi")
        return self.texts.select("row", "text").join(wanted, "row").select("node", "size", whole(F.col("text")).alias("set"))

    def _reach(self, place: Column, size: Column) -> Column:
        """Whether a set's shingles from a place on suffice for a partner that is no smaller."""
        num, den = self.similarity
        return (num + den) * (size - place) >= 2 * num * size

    def links(self, likely_pairs: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Verified pairs of nodes; together with equal sets they connect every class.

        ``likely_pairs`` makes pairs (a, b) of nodes from their texts (node, text): these are verified first, and the join looks for what they leave apart.
        """
        stars, _, more = self._found(likely_pairs)
        return stars if more is None else stars.union(more)

    def roots(self, likely_pairs: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """(node, root) of every node that has a link; the root is the least node of its class.

        The classes of the first round's links are known by then, so the later links, few of them, only join these classes.
        """
        _, rooted, more = self._found(likely_pairs)
        if more is None:
            return rooted
        a, b = (rooted.select(F.col("node").alias(s), F.col("root").alias(f"_{s}")) for s in "ab")
        more = more.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        merged = materialize(components(more), "merged")
        tops = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
        alone = merged.join(rooted, "node", "left_anti")  # without a link in the first round
        return rooted.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(alone)

    def _found(self, likely_pairs: Callable[[DataFrame], DataFrame] | None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """The first round's links, the classes (node, root) these make, and the links found between those classes, if any."""
        members = self.members()
        groups = materialize(members.groupBy("grp").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.min("node").alias("head"), F.count("*").alias("heads")), "groups")
        placed = groups.select("grp", "size", F.posexplode("prefix").alias("place", "shingle"))
        early = self._reach(F.col("place"), F.col("size"))
        buckets = placed.groupBy("shingle").agg(F.count("*").alias("n"), F.max(early).alias("early")).filter("n > 1")
        # stored, so that the joins with it are sort-merge joins, which adaptive execution splits
        met = materialize(placed.join(materialize(buckets, "buckets"), "shingle"), "met")
        several = materialize(groups.filter("heads > 1").select("grp", "head"), "several")
        inside = materialize(members.join(several, "grp").select("grp", "node", "head"), "inside")
        crowds = met.filter((F.col("n") > CROWDED) & F.col("early"))  # buckets with an early member

        likely = materialize(self._likely(met), "likely")
        best = [likely.groupBy(x).agg(F.max(F.struct("both", y)).alias("best")).select(F.col(x), F.col(f"best.{y}").alias(y)).select("a", "b") for x, y in ("ab", "ba")]
        strength = met.groupBy("grp").agg(F.sum("n").alias("strength"))
        # a set with few rare shingles before the crowded one is what most others are copies of
        centre = crowds.join(materialize(strength, "strength"), "grp").groupBy("shingle", F.pmod("grp", F.lit(CENTRES)).alias("salt"))
        centre = centre.agg(F.max(F.struct((-F.col("place")).alias("place"), "strength", "grp", "size")).alias("c"))
        centre = materialize(centre.select("shingle", F.col("c.grp").alias("centre"), F.col("c.size").alias("other")), "centres")
        star = crowds.join(centre, "shingle").filter(F.col("grp") != F.col("centre")).filter(self._near(F.col("size"), F.col("other")))
        star = star.select(F.least("grp", "centre").alias("a"), F.greatest("grp", "centre").alias("b"))
        own = inside.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
        first = self._heads(best[0].union(best[1]).union(star).distinct(), groups).union(own)
        if likely_pairs is not None:
            near = likely_pairs(self.texts.select("row", "text").join(self.nodes.select("node", "row"), "row").select("node", "text"))
            first = first.union(near.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
        stars = self._verified(first)

        rooted = materialize(components(stars), "rooted")
        # the groups that pairs are made of, their members' roots, and the least and the greatest of these
        used = met.select("grp").union(inside.select("grp")).distinct()
        tops = members.select("grp", "node").join(used, "grp", "left_semi").join(rooted, "node", "left")
        tops = materialize(tops.select("grp", "node", F.coalesce("root", "node").alias("root")), "roots")
        span = materialize(tops.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high")), "spans")
        rest = likely.select("a", "b").union(self._crowded(crowds.join(span, "grp"), groups))
        own = span.filter("low < high").select(F.col("grp").alias("x"), F.col("grp").alias("y"))
        x, y = (tops.select(F.col("grp").alias(s), F.col("node").alias(a), F.col("root").alias(f"_{a}")) for s, a in (("x", "a"), ("y", "b")))
        pairs = rest.toDF("x", "y").union(own).join(x, "x").join(y, "y").filter("_a <> _b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = materialize(pairs, "rest")
        more = None if pairs.isEmpty() else self._verified(pairs)
        forget(groups, met, likely, tops)
        return stars, rooted, None if more is None or more.isEmpty() else more

    def _near(self, m: Column, n: Column) -> Column:
        num, den = self.similarity
        return F.greatest(m, n) * num <= F.least(m, n) * den

    def _beyond(self, size: Column) -> Column:
        """Shingles of a set after its prefix."""
        num, den = self.similarity
        return F.ceil(size * num / den) - 1

    def _enough(self, both: Column, m: Column, n: Column) -> Column:
        """Whether sets that share so many shingles of their prefixes may be similar.

        Up to the earlier end of the two prefixes all of both sets is known; only what that set has after it may still be shared.
        """
        num, den = self.similarity
        return (num + den) * (both + F.greatest(self._beyond(m), self._beyond(n))) >= num * (m + n)

    def _likely(self, met: DataFrame) -> DataFrame:
        """(a, b, both) of groups that share a bucket of at most CROWDED groups: their shared shingles, crowded ones at most."""
        crowded = materialize(met.filter(F.col("n") > CROWDED).groupBy("grp").agg(F.count("*").alias("crowded")), "crowded")
        light = materialize(met.filter(F.col("n") <= CROWDED).join(crowded, "grp", "left").select("shingle", "grp", "size", F.coalesce("crowded", F.lit(0)).alias("crowded")), "light")
        both = light.alias("x").join(light.alias("y"), "shingle").filter((F.col("x.grp") < F.col("y.grp")) & self._near(F.col("x.size"), F.col("y.size")))
        both = both.select(F.col("x.grp").alias("a"), F.col("y.grp").alias("b"), F.col("x.size").alias("m"), F.col("y.size").alias("n"), F.least("x.crowded", "y.crowded").alias("more"))
        both = both.groupBy("a", "b", "m", "n", "more").agg(F.count("*").alias("both"))
        return both.filter(self._enough(F.col("both") + F.col("more"), F.col("m"), F.col("n"))).select("a", "b", "both")

    def _crowded(self, crowds: DataFrame, groups: DataFrame) -> DataFrame:
        """(a, b) of groups that share a crowded bucket in which some are not connected yet; the first one has it early."""
        mixed = materialize(crowds.groupBy("shingle").agg(F.min("low").alias("least"), F.max("high").alias("most")).filter("least < most").select("shingle"), "mixed")
        prefix = groups.select("grp", "prefix").join(crowds.join(mixed, "shingle").select("grp").distinct(), "grp", "left_semi")
        left = crowds.join(mixed, "shingle").join(materialize(prefix, "crowd"), "grp").select("shingle", "grp", "size", "place", "low", "high", "prefix")
        left = materialize(left, "left")
        x, y = left.filter(self._reach(F.col("place"), F.col("size"))).alias("x"), left.alias("y")
        apart = (F.col("x.low") < F.col("y.high")) | (F.col("y.low") < F.col("x.high"))
        smaller = (F.col("x.size") < F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.grp") < F.col("y.grp")))
        both = F.size(F.array_intersect("x.prefix", "y.prefix"))
        may = smaller & apart & self._near(F.col("x.size"), F.col("y.size")) & self._enough(both, F.col("x.size"), F.col("y.size"))
        return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & may).select(F.col("x.grp").alias("a"), F.col("y.grp").alias("b")).distinct()

    @staticmethod
    def _heads(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        a, b = (groups.select(F.col("grp").alias(k), F.col("head").alias(f"_{k}")) for k in "ab")
        return pairs.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) of nodes whose whole sets are similar."""
        num, den = self.similarity
        pairs = materialize(pairs, "pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = materialize(self._whole(nodes).drop("size"), "sets")
        a, b = (sets.select(F.col("node").alias(s), F.col("set").alias(f"_{s}")) for s in "ab")
        both = F.size(F.array_intersect("_a", "_b"))
        found = pairs.join(a, "a").join(b, "b").filter((num + den) * both >= num * (F.size("_a") + F.size("_b"))).select("a", "b")
        found = materialize(found, "links")
        forget(sets, pairs)
        return found


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, similarity: tuple[int, int] = SIMILARITY,
            likely_pairs: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(row, id, size, root): each row with its class; rows without a word have root null."""
    join = Join(docs, id_col, text_col, k, similarity)
    rooted = materialize(join.roots(likely_pairs), "rooted")
    roots = materialize(join.nodes.select("node").join(rooted, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    forget(join.nodes)
    return materialize(join.rows.join(roots, "node", "left").select("row", "id", "size", "root"), "classes")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: tuple[int, int] = (4, 5),
             likely_pairs: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of ``docs`` less near copies: of each class the row with the smallest id (null last) stays; rows without a word are one class."""
    found = classes(docs, id_col, text_col, k, similarity, likely_pairs)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"))
    kept = materialize(least.select("least.row"), "kept")
    # carried under a name that no column of the input has
    name = "row"
    while name in docs.columns:
        name = "_" + name
    return docs.withColumn(name, F.monotonically_increasing_id()).join(kept.withColumnRenamed("row", name), name, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op11_ngram_join")
def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = classes(table(spark, folder, "documents"))
    # rows that no link touches, rows without a word among them, are their own
    least = materialize(found.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id")), "least")
    return found.join(least, "root", "left").select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
