"""SimHash near-duplicates by covering locality-sensitive hashing (operator 7).

A fingerprint bit is 1 if it is set in more than half of the shingle hashes. Bit positions carry nonzero vectors of
``radius + 1`` binary digits; the mask of every nonzero vector keeps the positions it is not orthogonal to. Any
``radius`` positions are all dropped by some mask, so every pair within the radius has one masked value in common:
2^(radius+1) - 1 tables miss nothing. Fingerprints that meet no other in any table are done.

The others are verified without pairing a bucket's members: members of one bucket differ in dropped bits only, and
two of them lie within two bits of each other exactly if both lie within one bit of some common centre. So each
member names itself and its one-bit changes at dropped bits as centres, and each centre (at most 65 members, whatever the
bucket's size) links its members, which are all within two bits.

Null and empty texts, and texts without a word, have fingerprint zero and are linked like any other. Repeated rows and
null ids are kept; a component's id is its smallest id that is not null. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, query, release_worker_state, table
from .components import components

#: Production parameters.
SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42


def fingerprint_of(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text; ``lower`` and ``split`` of bytes know A-Z and \\x20\\x09-\\x0D only."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    stops = ends[-n:].tolist()
    hashes = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def simhash(column: pa.Array) -> pa.Array:
        release_worker_state()
        values = np.fromiter(
            (fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle_words, seed) for x in column), np.uint64, len(column)
        )
        return pa.array(values.view(np.int64))

    return simhash(text.cast("binary")).alias("fingerprint")


def masks(radius: int, bits: int = 64) -> list[int]:
    """Covering masks: for any ``radius`` bits, some mask keeps none of them."""
    vectors = 2 ** (radius + 1) - 1
    return [
        sum(1 << i for i in range(bits) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``-``b`` that connect all distinct fingerprints within ``radius`` (1 or 2) differing bits."""
    if radius not in (1, 2):
        raise ValueError("centres verify one or two bits")
    kept = masks(radius)
    held = materialize(
        fingerprints.select("fingerprint", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(_long(m)) for m in kept]))
                            .alias("mask", "value")), "masked",
    )
    # stored, so that the join below has a shuffle on either side and adaptive execution can split a crowded bucket
    shared = materialize(held.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "buckets")
    dropped = F.element_at(F.array(*[F.array(*[F.lit(i) for i in range(64) if not m >> i & 1]) for m in kept]), F.col("mask") + 1)
    centre = F.explode(F.concat(F.array(F.lit(-1)), dropped)).alias("bit")
    flip = F.when(F.col("bit") >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).otherwise(F.lit(0).cast("long"))
    centres = (
        held.join(shared, ["mask", "value"], "left_semi").select("fingerprint", centre).select("fingerprint", "bit", flip.alias("flip"))
        .groupBy(F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("centre"))
        .agg(F.bit_or("flip").alias("flips"), F.max(F.col("bit") < 0).alias("own"))
        .filter(F.bit_count("flips") + F.col("own").cast("int") > 1)
    )
    members = F.concat(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("getbit", F.col("flips"), b) == 1),
            lambda b: F.col("centre").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)),
        ),
        F.when(F.col("own"), F.array("centre")).otherwise(F.array().cast("array<bigint>")),
    )
    return (
        centres.select(members.alias("members")).select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
        .filter("a <> b").distinct()
    )


def near_duplicates(fingerprints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component_id) of every distinct fingerprint of a stored (id, fingerprint) table."""
    nodes = materialize(fingerprints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "nodes")
    rooted = components(links(nodes, radius)).withColumnRenamed("node", "fingerprint")
    nodes = nodes.join(rooted, "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = materialize(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    return nodes.join(least, "root").select("fingerprint", "component_id")


def near_pairs(texts: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of the nodes of a table (node, text) that connect all whose fingerprints are within the radius, as ``links`` does.

    Of equal fingerprints the least node stands for all and meets each of the others; every link of two fingerprints is one of their least nodes.
    A fingerprint is in at most 65 centres and has at most one link to the least of each, so the pairs grow with the nodes.
    """
    named = materialize(texts.select("node", fingerprint(F.col("text"), shingle_words)), "fingerprints")
    heads = materialize(named.groupBy("fingerprint").agg(F.min("node").alias("head")), "heads")
    equal = named.join(heads, "fingerprint").filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    a, b = (heads.select(F.col("fingerprint").alias(s), F.col("head").alias(f"_{s}")) for s in "ab")
    met = links(heads.select("fingerprint"), radius).join(a, "a").join(b, "b")
    return materialize(equal.union(met.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "near")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
             shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component, one row with its smallest id stays.

    The rows are stored once with a number of their own, so that rows with the same id or none are told apart.
    """
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_fp", fingerprint(F.col(text_col), shingle_words)), "rows")
    named = rows.select(F.col("_row"), F.col(id_col).alias("doc_id"), F.col("_fp").alias("fingerprint"))
    found = near_duplicates(named.select("doc_id", "fingerprint"), "doc_id", radius)
    first = (
        named.join(found, "fingerprint")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        # ids that several components lack (null) are told apart by fingerprint
        .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("f"))
        .agg(F.min("_row").alias("_row"))
    )
    return rows.join(first.select("_row"), "_row", "left_semi").select(*docs.columns)


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fingerprints = materialize(docs.select("doc_id", fingerprint(F.col("text"))), "fingerprints")
    found = near_duplicates(fingerprints)
    return fingerprints.join(found, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
