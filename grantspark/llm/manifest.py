"""Merkle manifest of a dataset by nested-struct rollup (operator 12).

Rows are leaves, numbered within their language by an order that is total but for equal rows. The number's base-8 digits are grouped away
one after the other: the last digit's children nest as an array of structs in their node, that node in the next, up to a block of
``8 ** DIGITS`` leaves. A block's rows are brought together once; the groupings inside it need no further exchange, and no
task ever holds more than blocks. The blocks' own hashes are leaves of the next round, until one node a language is left; the languages'
roots are leaves of the last tree.

On the way back a block meets the path above it in one grouping, and a transform and an explode per digit give every child its
siblings: the proofs come out of the nested structs, no leaf is joined with a node.

Any column may be null; null ids come first in their language and a null language is one of its own, before the others. Equal rows are leaves
of their own (in either order the hashes are the same). An empty table gives no rows. Only the five named columns are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_of_id, materialize, query, table

#: Base-8 digits of a block: 4,096 leaves.
DIGITS = 4
_NO_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows, stored, with ``number`` from 0 in the given order, without a window over all: ranges are sorted alone and shifted by
    the counts before them. Equal rows are told apart by where they were read, so no range gathers them."""
    at = F.monotonically_increasing_id()
    ranged = rows.withColumn("_at", at).repartitionByRange(*order, F.col("_at")).sortWithinPartitions(*order, F.col("_at"))
    ranged = ranged.drop("_at").withColumns({"_part": F.spark_partition_id(), "_place": at.bitwiseAND((1 << 33) - 1)})
    ranged = materialize(ranged, "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shift = materialize(ranged.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")), "shifts")
    return ranged.join(shift, "_part").withColumn("number", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def rolled(nodes: DataFrame, below: int) -> DataFrame:
    """Blocks (g, n, block, hash, tree) of nodes (g, n, r, hash, load) that stand ``below`` levels above the leaves.

    ``n`` counts a group's leaves, so it says how many nodes every level has; a level with one node is the top, which is not hashed again.
    """
    level = nodes.select("g", "n", F.shiftright("r", 3 * DIGITS).alias("block"), "r", "hash", F.col("load").alias("tree")).repartition("g", "block")
    for digit in range(DIGITS):
        child = F.struct(F.col("r").bitwiseAND(7).alias("digit"), "hash", "tree")
        level = level.withColumn("child", child).withColumn("r", F.shiftright("r", 3)).groupBy("g", "n", "block", "r").agg(F.sort_array(F.collect_list("child")).alias("tree"))
        joined = digest(F.array_join(F.transform("tree", lambda c: c["hash"]), ""))
        level = level.select("g", "n", "block", "r", F.when(_several(below + digit), joined).otherwise(F.col("tree")[0]["hash"]).alias("hash"), "tree")
    return level.drop("r")


def _several(level: int) -> Column:
    """Whether a group of ``n`` leaves has more than one node at a level."""
    return F.col("n") > (1 << 3 * level)


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Stored blocks of every round; in the last one each group is one block, with the group's root as hash."""
    rounds = []
    while True:
        rounds.append(materialize(rolled(nodes, DIGITS * len(rounds)), "blocks"))
        most = rounds[-1].agg(F.max("block")).first()[0]
        if not most:
            return rounds
        nodes = rounds[-1].select("g", "n", F.col("block").alias("r"), "hash", F.lit(None).cast("int").alias("load"))


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(g, r, hash, load, path, tops) of the first round's nodes; ``above`` (g, path, tops) holds what lies over each group's root.

    ``path`` lists, from the node up, what stands left and right of it in its run.
    """
    above = above.select("g", F.lit(0).cast("long").alias("block"), "path", "tops")
    for number in range(len(rounds) - 1, -1, -1):
        blocks = rounds[number].select("g", "block", "n", "tree")
        both = blocks.unionByName(above.withColumns({"n": F.lit(None), "tree": F.lit(None)}).select("g", "block", "n", "tree", "path", "tops"), allowMissingColumns=True)
        met = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "tree", "path", "tops")])
        level = met.select("g", "n", F.col("block").alias("r"), "tree", "path", "tops", F.lit(None).cast("string").alias("hash"))
        for digit in range(DIGITS - 1, -1, -1):
            level = _children(level, _several(DIGITS * number + digit))
        if number:
            above = level.select("g", F.col("r").alias("block"), "path", "tops")
    return level.select("g", "r", "hash", F.col("tree").alias("load"), "path", "tops")


def _children(level: DataFrame, several: Column) -> DataFrame:
    """One row per child of each row's nested run, with the run's others put before the path."""

    def child(c: Column, i: Column) -> Column:
        left, right = (F.array_join(F.transform(part, lambda s: s["hash"]), "") for part in (F.slice("tree", F.lit(1), i), F.slice("tree", i + 2, F.lit(8))))
        run = F.struct(left.alias("left"), right.alias("right"))
        return F.struct(c["digit"].alias("digit"), c["hash"].alias("hash"), c["tree"].alias("tree"), F.when(several, F.concat(F.array(run), F.col("path"))).otherwise(F.col("path")).alias("path"))

    return level.select("g", "n", F.col("r").alias("up"), "tops", F.explode(F.transform("tree", child)).alias("c")).select(
        "g", "n", (F.shiftleft("up", 3) + F.col("c.digit")).alias("r"), "c.tree", "c.path", "tops", "c.hash"
    )


def manifest(leaves: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, changed, subroot, root, path) of leaves (doc_id, lang, leaf, changed), proofs included.

    ``changed`` is carried along: a leaf to be checked in place of the one in the tree, or null.
    """
    rows = materialize(numbered(leaves.select("doc_id", "lang", "leaf", "changed"), F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")), "numbered")
    langs = rows.groupBy("lang").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    langs = materialize(numbered(langs, F.col("lang").asc_nulls_first()).withColumnRenamed("number", "g"), "languages")
    m = langs.count()
    nodes = rows.alias("x").join(langs.alias("l"), F.col("x.lang").eqNullSafe(F.col("l.lang"))).select(
        "g", "n", (F.col("number") - F.col("first")).alias("r"), F.col("leaf").alias("hash"), F.struct("doc_id", "changed").alias("load")
    )
    rounds = climb(nodes)
    subroots = rounds[-1].select(F.lit(0).cast("long").alias("g"), F.lit(m).cast("long").alias("n"), F.col("g").alias("r"), "hash", F.lit(None).cast("int").alias("load"))
    over = climb(subroots)
    root = over[-1].select("g", F.array().cast(_NO_PATH).alias("path"), F.struct(F.col("hash").alias("root")).alias("tops"))
    above = descend(over, root).select(F.col("r").alias("g"), "path", F.struct("tops.root", F.col("hash").alias("subroot")).alias("tops"))
    found = descend(rounds, above)
    return found.select("load.doc_id", F.col("hash").alias("leaf"), "load.changed", "tops.subroot", "tops.root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, run: digest(F.concat(run["left"], node, run["right"])))


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


_UP, _DOWN = string.ascii_uppercase, string.ascii_lowercase
_F = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_HEAD = "||".join(_F.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
d AS (SELECT row_number() OVER () AS k, doc_id, lang, sha256({_HEAD}||{_F.format('text')}) AS leaf,
  CASE WHEN xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)), lambda c, b: xor(tab[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8), 4294967295), 4294967295) % 3 = 0
    THEN sha256({_HEAD}||{_F.format(f"translate(text, '{_UP}', '{_DOWN}')")}) END AS changed FROM documents, crc),
g AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM d),
a AS (SELECT g, 0 AS lv, r, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM g
  UNION ALL SELECT g, lv + 1, r // 8, sha256(string_agg(h, '' ORDER BY r)), (n + 7) // 8 FROM a WHERE n > 1 GROUP BY g, lv, r // 8, n),
s AS (SELECT g, h AS subroot, max(lv) OVER () AS x FROM a WHERE n = 1),
b AS (SELECT 0 AS lv, CAST(g AS BIGINT) AS r, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL SELECT lv + 1, r // 8, sha256(string_agg(h, '' ORDER BY r)), (n + 7) // 8 FROM b WHERE n > 1 GROUP BY lv, r // 8, n),
ra AS (SELECT g, lv, r, n, coalesce(string_agg(h, '') OVER (PARTITION BY g, lv, r // 8 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS le,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, lv, r // 8 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS ri FROM a),
rb AS (SELECT lv, r, n, coalesce(string_agg(h, '') OVER (PARTITION BY lv, r // 8 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS le,
  coalesce(string_agg(h, '') OVER (PARTITION BY lv, r // 8 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS ri FROM b),
fa AS (SELECT k, g, 0 AS lv, r, coalesce(changed, leaf) AS node, '' AS proof, false AS done FROM g
  UNION ALL SELECT fa.k, fa.g, fa.lv + 1, fa.r // 8, CASE WHEN n > 1 THEN sha256(le||node||ri) ELSE node END, CASE WHEN n > 1 THEN proof||le||ri ELSE proof END, n = 1 FROM fa JOIN ra ON ra.g = fa.g AND ra.lv = fa.lv AND ra.r = fa.r WHERE NOT done),
fb AS (SELECT k, 0 AS lv, CAST(g AS BIGINT) AS r, node, proof, false AS done FROM fa WHERE done
  UNION ALL SELECT fb.k, fb.lv + 1, fb.r // 8, CASE WHEN n > 1 THEN sha256(le||node||ri) ELSE node END, CASE WHEN n > 1 THEN proof||le||ri ELSE proof END, n = 1 FROM fb JOIN rb ON rb.lv = fb.lv AND rb.r = fb.r WHERE NOT fb.done)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM g JOIN s USING (g) JOIN fb ON fb.k = g.k AND fb.done CROSS JOIN (SELECT h AS root FROM b WHERE n = 1)
"""


@query("op12_manifest", _SQL)
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves of all documents with their proofs; in every third one the text is lower-cased before it is checked."""
    docs = table(spark, folder, "documents")
    head = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.when(crc_of_id("doc_id") % 3 == 0, digest(F.concat(*head, field(lowered(F.col("text"))))))
    found = manifest(docs.select("doc_id", "lang", digest(F.concat(*head, field(F.col("text")))).alias("leaf"), changed.alias("changed")))
    # computed once per row, as two columns read it
    checked = found.select("*", F.explode(F.array(folded(F.coalesce("changed", "leaf"), F.col("path")))).alias("folded_root"))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", digest(proof_text(F.col("path"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
