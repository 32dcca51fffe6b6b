"""Which notices to work on next (Q01-Q04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions.deadlines import phases
from ..functions.text import says, squish
from ..session import materialize

ORDERS = ("new_first", "pending_first", "documents_chunks_only", "fetch")


def keep_members(notices: DataFrame, members: DataFrame) -> DataFrame:
    """Notices whose id is among ``members``; an empty set filters nothing."""
    ids = members.select("id").distinct().withColumn("_in", F.lit(True))
    empty = members.select("id").limit(1).agg(F.count("*")).scalar() == 0
    return notices.join(ids, "id", "left").where(F.coalesce("_in", F.lit(False)) | empty).drop("_in")


def filter_backlog(notices: DataFrame, catalogue: DataFrame | None = None, attached: DataFrame | None = None, chunked: DataFrame | None = None,
                   weak: DataFrame | None = None) -> DataFrame:
    """Not yet published, with attachments, with chunks, with fields to extract; each filter optional."""
    out = notices
    if catalogue is not None:
        out = out.join(catalogue.select("id"), "id", "left_anti")
    if attached is not None:
        out = keep_members(out, attached)
    if chunked is not None:
        out = keep_members(out, chunked)
    if weak is not None:
        out = out.join(weak.where("needs_any").select("id"), "id", "left_semi")
    return out


def order_work(notices: DataFrame, mode: str = "new_first", chunk_counts: DataFrame | None = None, needs: DataFrame | None = None) -> DataFrame:
    """Notices in working order with the keys they are sorted by; the id makes the order total."""
    out = notices
    if chunk_counts is not None:
        out = out.join(chunk_counts.select("id", "chunks"), "id", "left")
    else:
        out = out.withColumn("chunks", F.lit(None).cast("long"))
    if needs is not None:
        out = out.join(needs.select("id", "needs_any"), "id", "left")
    else:
        out = out.withColumn("needs_any", F.lit(None).cast("boolean"))
    out = out.withColumn("processed", F.col("informacoes_processadas_em").isNotNull())
    newest = [F.desc_nulls_last("criado_em"), F.col("id")]
    # rank by chunks is rank by (count desc, id); notices without chunks follow all others
    by_chunks = [F.desc_nulls_last("chunks"), F.when(F.col("chunks").isNotNull(), F.col("id")).asc_nulls_last()]
    keys = {
        "new_first": [F.col("processed"), *newest],
        "pending_first": [*by_chunks, F.desc_nulls_last("needs_any"), *newest],
        "documents_chunks_only": [*by_chunks, *newest],
        "fetch": newest,
    }
    return out.orderBy(*keys[mode])


def numbered(ordered: DataFrame) -> DataFrame:
    """Rows of a sorted frame with their place ``pos`` from 1.

    The sort deals rows out by range, so a place is the row's index in its partition plus the counts of those before; only
    these counts, one row per partition, are summed in order.
    """
    rows = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.withColumn("_part", part).join(sizes, "_part").withColumn("pos", inside + F.col("_before") + 1).drop("_at", "_part", "_before")


def take_batch(ordered: DataFrame, limit: int | None = None, only_id=None) -> DataFrame:
    if only_id is not None:
        return ordered.where(F.col("id") == only_id)
    return ordered.limit(limit) if limit else ordered


def meaningful(field: str) -> Column:
    """Whether a stored field says something, for the audit."""
    if field in ("is_researcher", "is_company"):
        return F.col(field).isNotNull()
    if field == "timeline_estimada":
        return F.coalesce(F.size(phases(field)) > 0, F.lit(False))
    return ~says(squish(field), "", "não informado")


def extracted_fields(notices: DataFrame) -> DataFrame:
    names = F.array_compact(F.array(*[F.when(meaningful(f), F.lit(f)) for f in FIELDS]))
    return notices.withColumn("extracted", names)


def validation_candidates(notices: DataFrame, catalogue: DataFrame, reprocess: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """Processed notices with extracted fields, not yet published unless asked; newest first or in the given order (id, pos)."""
    n = notices.join(ids, "id") if ids is not None else notices.where("informacoes_processadas_em IS NOT NULL")
    if not reprocess:
        n = n.join(catalogue.select("id"), "id", "left_anti")
    n = extracted_fields(n).where(F.size("extracted") > 0)
    return n.orderBy("pos") if ids is not None else n.orderBy(F.desc("informacoes_processadas_em"), "id")
