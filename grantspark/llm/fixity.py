"""WARC fixity audit over Merkle trees (operator 2).

Records are hashed, then ordered offset ranges of a file (64 KB, then 1 MB, then the file), then runs of 16 files, up to one
root. Two replicas whose roots agree are equal, and nothing else is read. Otherwise each level compares only the children of
ranges that differ above, down to the records; the ranges that differ are stored per level. Every node has few children (bounded by the bytes of its range, or 16), so no task
gathers a file, and node tables are stored once per level.

Null addresses and bodies count as empty. Pages without a number go to files of their own, by a hash. Repeated rows are records
of their own, ordered by address and body. Two empty replicas agree. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import copies, materialize, query, table

#: Bits of an offset that a range leaves out, from the finest level up; above them one file, then runs of files.
RANGE_BITS = (16, 20)
FILE_BITS = 4
PAGES_PER_FILE = 1000


def warc_record(page: Column, url: Column, body: Column) -> Column:
    """The bytes of one resource record."""
    body = F.coalesce(body.cast("binary"), F.lit("").cast("binary"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page.cast("string"), F.lit("-")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def file_of(page: Column, *others: Column) -> Column:
    return F.coalesce(F.floor(page / PAGES_PER_FILE), -1 - F.pmod(F.xxhash64(*others), F.lit(1 << 40))).cast("long")


def with_offsets(records: DataFrame, *order: str) -> DataFrame:
    """Add each record's offset in its file, in the given order.

    Equal records are counted and placed as one run. Runs are dealt out by range and stored, their lengths summed within
    (file, range) and shifted by the ranges before, so a file or a page number that many rows repeat is no single task.
    """
    runs = records.groupBy(*[F.col(f"`{c}`") for c in records.columns]).agg(F.count("*").alias("_n"))
    runs = materialize(runs.repartitionByRange("file", *order, F.xxhash64(*records.columns)).withColumn("_block", F.spark_partition_id()), "runs")
    sizes = runs.groupBy("file", "_block").agg(F.sum(F.col("length") * F.col("_n")).alias("_size"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("file", "_block").orderBy(*order, F.xxhash64(*records.columns)).rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("_before", F.coalesce(F.sum(F.col("length") * F.col("_n")).over(inside), F.lit(0))).join(starts, ["file", "_block"])
    return copies(placed).select(*records.columns, (F.col("_start") + F.col("_before") + F.col("_i") * F.col("length")).alias("offset"))


def _above(level: int, depth: int) -> list[Column]:
    """Key of a node's parent, from the node's own key; the top level is one node."""
    if level + 1 == depth:
        return [F.lit(0).cast("long").alias("file"), F.lit(0).cast("long").alias("offset")]
    if level < len(RANGE_BITS):
        bits = RANGE_BITS[level]
        return [F.col("file"), F.shiftleft(F.shiftright("offset", bits), bits).alias("offset")]
    step = 0 if level == len(RANGE_BITS) else FILE_BITS
    return [F.shiftright("file", step).alias("file"), F.lit(0).cast("long").alias("offset")]


def depth_of(*replicas: DataFrame) -> int:
    """Levels above the records: ranges, files, runs of files until at most one of either sign is left, and the root."""
    runs = 0
    for replica in replicas:
        least, most = replica.agg(F.min("file"), F.max("file")).first()
        while most is not None and (least >> FILE_BITS * runs < -1 or most >> FILE_BITS * runs > 0):
            runs += 1
    return len(RANGE_BITS) + 1 + runs + 1


def merkle(records: DataFrame, depth: int) -> list[DataFrame]:
    """Node tables (file, offset, hash) by level; level 0 holds the records (file, offset, hash), stored by the caller."""
    levels = [records.select("file", "offset", "hash")]
    for level in range(depth):
        file, offset = _above(level, depth)
        children = F.array_sort(F.collect_list(F.struct(F.col("child_file"), F.col("child_offset"), F.col("hash"))))
        nodes = (
            levels[-1].select(file, offset, F.col("file").alias("child_file"), F.col("offset").alias("child_offset"), "hash")
            .groupBy("file", "offset").agg(F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["child_offset"], c["hash"])), "\n").cast("binary"), 256).alias("hash"))
        )
        levels.append(materialize(nodes, "nodes"))
    return levels


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, offset, problem) of the records that differ between two stored replicas (file, offset, hash).

    ``problem`` is corrupt, missing (not in theirs) or extra (not in ours).
    """
    depth = depth_of(ours, theirs)
    left, right = merkle(ours, depth), merkle(theirs, depth)
    suspects = None
    for level in range(depth, -1, -1):
        a, b = left[level], right[level]
        if suspects is not None:
            file, offset = _above(level, depth)
            a, b = (
                x.withColumns({"up_file": file, "up_offset": offset}).join(suspects, ["up_file", "up_offset"], "left_semi").select("file", "offset", "hash")
                for x in (a, b)
            )
        differing = (
            a.withColumnRenamed("hash", "a").join(b.withColumnRenamed("hash", "b"), ["file", "offset"], "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        )
        if level == depth and differing.isEmpty():
            return differing.select("file", "offset", F.lit("equal").alias("problem"))
        if level:
            suspects = materialize(differing.select(F.col("file").alias("up_file"), F.col("offset").alias("up_offset")), "suspects")
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt")
    return differing.select("file", "offset", problem.alias("problem"))


_SQL = """
WITH r AS (SELECT page_id, page_id // 1000 AS file, url,
    161 + strlen(CAST(page_id AS VARCHAR)) + strlen(coalesce(url, '')) + strlen(CAST(strlen(coalesce(html, '')) AS VARCHAR)) + strlen(coalesce(html, '')) AS length,
    html FROM pages),
o AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, url, html ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM r)
SELECT page_id, file, CAST("offset" AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
    CASE WHEN page_id % 389 = 7 THEN 'missing' ELSE 'corrupt' END AS problem
FROM o WHERE page_id % 97 = 5 OR page_id % 389 = 7
"""


@query("op2_fixity", _SQL)
def op2_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as WARC files, and a replica in which every 97th record has a damaged byte and every 389th is lost."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    damaged = F.overlay(F.col("record"), F.lit("\x01").cast("binary"), F.octet_length("record") - 5)
    both = materialize(
        with_offsets(
            pages.select("page_id", file_of(F.col("page_id"), F.col("url"), F.col("html")).alias("file"), "url", "html", record.alias("record"))
            .select("page_id", "file", "url", F.sha2("html", 256).alias("tie"), F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash"),
                    F.when(F.col("page_id") % 97 == 5, F.sha2(damaged, 256)).otherwise(F.sha2("record", 256)).alias("copy")),
            "page_id", "url", "tie",
        ), "records",
    )
    found = audit(both.select("file", "offset", "hash"), both.filter("NOT coalesce(page_id % 389 = 7, false)").select("file", "offset", F.col("copy").alias("hash")))
    return both.select("page_id", "file", "offset", "length").join(found, ["file", "offset"])
