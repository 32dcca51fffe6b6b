"""Chunks of a notice: association, ranking and context packing.

Frames: ``assoc`` (notice_id, id, file_id, content, chunk_index, embeddings), ``scores`` (notice_id,
field, id, score), ``ranked`` (notice_id, field, rn, id, score). Every chunk is read; positions and running
sums are found in blocks and shifted by the blocks before, so no window or fold holds a whole notice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions import prompts
from ..functions.frames import compute
from ..functions.vectors import finite
from ..session import materialize
from .chunks import BLOCK, blockwise_batches
from ..functions.text import blank, has, head, none_if_blank, strip

# How many chunks each field looks at; every other field takes DEFAULT_TOP_K.
FIELD_TOP_K = {"valor_projeto": 25, "prazo_inscricao": 60, "timeline_estimada": 70, "criterios_elegibilidade": 55, "sobre_programa": 45}
DEFAULT_TOP_K = 35
# Wording that makes a chunk more likely to hold the value of a project.
AMOUNT = r"R\$\s*\d"
PROJECT_VALUE = (
    r"(?<![0-9A-Za-z_])(?:por|cada|para cada)\s+(?:proposta|projeto|empresa|plano)"
    r"|(?<![0-9A-Za-z_])valor\s+(?:m[aá]ximo|m[ií]nimo|global|total)|(?<![0-9A-Za-z_])teto(?![0-9A-Za-z_])"
    r"|(?<![0-9A-Za-z_])recursos?\s+(?:financeiros?\s+)?(?:destinad|dispon[ií]ve|previst|or[cç]ad)"
)
# Weighted terms near the facts of a project's execution.
EXECUTION_TERMS = (
    (r"prazo de execu|vig[êe]ncia|dura[çc][ãa]o|(?<![0-9A-Za-z_])\d{1,2}\s*\(?[a-z ]*\)?\s*meses(?![0-9A-Za-z_])", 4),
    (r"parcela|desembols|libera[çc][ãa]o (dos )?recursos|aporte|cronograma de desembolso", 4),
    (r"transferegov|plataforma \+?brasil|siconv", 6),
    (r"(?<![0-9A-Za-z_])obras?(?![0-9A-Za-z_])|constru[çc][ãa]o civil|edifica[çc]|reforma|infraestrutura f[íi]sica", 3),
    (r"(?<![0-9A-Za-z_])clt(?![0-9A-Za-z_])|celetista|consolida[çc][ãa]o das leis do trabalho|contrata[çc][ãa]o de pessoal|despesas? com pessoal", 4),
    (r"14\.?133|lei de licita|licita[çc][ãa]o", 4),
    (r"valor (m[áa]ximo|global|total)|R\$\s*\d", 2),
    (r"pesquisa|inova[çc][ãa]o|desenvolvimento tecnol|P&D|PD&I", 1),
    (r"itens financi[áa]veis|despesas (de capital|correntes)|n[ãa]o ser[ãa]o financiad|vedad", 3),
)
# Weighted terms near a monthly stipend.
STIPEND_TERMS = ((AMOUNT, 4), (r"mensal|por mês|ao mês", 3), (r"ATP|bolsa", 1))


def associate_chunks(chunks: DataFrame, attachments: DataFrame) -> DataFrame:
    """(notice_id, id) pairs: by metadata notice, by file, by metadata file; once per pair.

    Three equi-joins instead of one join on OR, so each can be hashed, spread and split when skewed.
    """
    files = (
        attachments.select(
            F.col("edital_id").cast("string").alias("notice_id"), F.explode(F.array(F.col("id").cast("string"), F.col("file_id"))).alias("file_key")
        )
        .where("notice_id IS NOT NULL AND file_key <> ''")
        .distinct()
    )
    if "content" in chunks.columns:  # else the chunks were already reduced to those with text
        chunks = chunks.where(strip("content") != "")
    keys = chunks.select(
        "id", none_if_blank(F.trim("file_id")).alias("f"), none_if_blank(F.trim("metadata.file_id")).alias("mf"), none_if_blank(F.trim("metadata.edital_id")).alias("mn")
    )
    direct = keys.where("mn IS NOT NULL").select(F.col("mn").alias("notice_id"), "id")
    by_file = keys.where("f IS NOT NULL").select("id", F.col("f").alias("file_key")).join(files, "file_key").select("notice_id", "id")
    # a metadata file equal to the chunk's own adds no new pair
    other = keys.where("mf IS NOT NULL AND NOT mf <=> f").select("id", F.col("mf").alias("file_key"))
    by_meta = other.join(files, "file_key").select("notice_id", "id")
    return direct.unionByName(by_file).unionByName(by_meta).distinct()


def notice_chunks(pairs: DataFrame, chunks: DataFrame, *columns: str) -> DataFrame:
    """Pairs with the chunk columns a job needs, and the order index."""
    picked = chunks.select("id", F.col("metadata.file_id").alias("meta_file_id"), F.col("metadata.chunk_index").alias("order_index"), *columns)
    return pairs.join(picked, "id")


def rank_notices_by_chunks(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("notice_id").agg(F.count("*").alias("chunks")).orderBy(F.desc("chunks"), "notice_id")


def reading_order(rows: DataFrame, cap: int | None = None) -> DataFrame:
    """Position of each chunk in its notice; with ``cap`` only the first so many.

    The keys alone are dealt out by range and stored, ranked within (notice, range), and shifted by the counts of the ranges before.
    """
    keys = rows.select("notice_id", "id", F.coalesce("order_index", F.lit(-1)).alias("oi")).repartitionByRange("notice_id", "oi", "id")
    keys = materialize(keys.withColumn("block", F.spark_partition_id()), "reading-order")
    sizes = keys.groupBy("notice_id", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("notice_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("notice_id", "block", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("notice_id", "block").orderBy("oi", "id"))
    placed = keys.withColumn("rank", rank).join(sizes, ["notice_id", "block"]).select("notice_id", "id", (F.col("rank") + F.col("before")).alias("pos"))
    if cap is not None:
        placed = placed.where(F.col("pos") <= cap)
    return rows.join(placed, ["notice_id", "id"])


def plain_text_spans(ordered: DataFrame) -> DataFrame:
    """[start, end) of each chunk in its notice's text, chunks joined by two characters."""
    rows = compute(ordered.select("notice_id", "id", "pos", "content"), n=F.length(strip("content"))).where("n > 0").drop("content")
    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK))
    sizes = rows.groupBy("notice_id", "block").agg(F.sum(F.col("n") + 2).alias("size"))
    before = F.sum("size").over(W.partitionBy("notice_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("notice_id", "block", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum(F.col("n") + 2).over(W.partitionBy("notice_id", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("inside", inside).join(sizes, ["notice_id", "block"]).withColumn("end", F.col("before") + F.col("inside") - 2)
    return rows.select("notice_id", "id", "pos", F.expr("end - n").alias("start"), "end")


def plain_lengths(ordered: DataFrame) -> DataFrame:
    """Length of each notice's joined text, without building it."""
    rows = compute(ordered.select("notice_id", "content"), n=F.length(strip("content"))).where("n > 0")
    return rows.groupBy("notice_id").agg((F.sum(F.col("n") + 2) - 2).alias("plain_len"))


def span_lengths(spans: DataFrame) -> DataFrame:
    """Length of each notice's joined text, from its spans."""
    return spans.groupBy("notice_id").agg(F.max("end").alias("plain_len"))


def span_overlap_join(spans: DataFrame, windows: DataFrame, bucket: int = 4096) -> DataFrame:
    """Chunks touching each text window (notice_id, window_index, w_start, w_end).

    Spans and windows are listed under every stretch of ``bucket`` characters they touch and meet there, so a long notice is
    many keys and a pair is looked at only near its place; it is kept in the first stretch that both touch. Rows with a
    null bound touch nothing.
    """

    def dealt(rows: DataFrame, start: str, end: str) -> DataFrame:
        first = F.floor(F.col(start) / bucket)
        last = F.greatest(first, F.floor((F.col(end) - 1) / bucket))
        return rows.select("*", first.alias("_first"), F.explode(F.sequence(first, last)).alias("_bucket"))

    s = dealt(spans.select("notice_id", "id", "start", "end"), "start", "end").withColumnRenamed("_first", "_s")
    w = dealt(windows.select("notice_id", "window_index", "w_start", "w_end"), "w_start", "w_end").withColumnRenamed("_first", "_w")
    met = s.join(w, ["notice_id", "_bucket"]).where("end > w_start AND start < w_end AND _bucket = greatest(_s, _w)")
    return met.select("notice_id", "window_index", "id")


def cosine_scores(rows: DataFrame, queries: dict[str, Sequence[float]], full: bool = False, keep: Sequence[str] = ("notice_id", "id")) -> DataFrame:
    """Cosine of each row's vector with each field's query vector, over their common length.

    The question vector is preferred unless ``full``; -1 where a norm is zero. The few query vectors
    are parameters of the job; one Arrow pass scores all fields.
    """
    names = list(queries)
    q = [np.asarray(queries[n], dtype="float64") for n in names]

    def score_batch(vectors: list) -> np.ndarray:
        out = np.empty((len(vectors), len(q)))
        groups: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            groups.setdefault(len(v), []).append(i)
        for size, where in groups.items():
            m = np.stack([vectors[i] for i in where]).astype("float64")
            for j, query in enumerate(q):
                n = min(size, len(query))
                a, b = m[:, :n], query[:n]
                norm = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum())
                out[where, j] = np.where(norm > 0, (a @ b) / np.where(norm > 0, norm, 1), -1.0)
        return out

    @F.pandas_udf("array<double>")
    def scores(v: pd.Series) -> pd.Series:
        return pd.Series(list(score_batch(v.tolist())))

    def valid(c: str) -> Column:
        return F.when((F.size(c) >= 4) & finite(c), F.col(c))

    vector = valid("embedding") if full else F.coalesce(valid("embedding_perguntas"), valid("embedding"))
    v = rows.withColumn("_v", vector).where("_v IS NOT NULL").select(*keep, scores("_v").alias("_s"))
    labels = F.array(*[F.lit(n) for n in names])
    return v.select(*keep, F.inline(F.arrays_zip(labels.alias("field"), F.col("_s").alias("score"))))


def query_vectors(queries: DataFrame) -> dict[str, list[float]]:
    """Field query vectors (field, vector): one for each of the fixed field names, the least of several; other names are no field."""
    one = queries.where(F.col("field").isin(*FIELDS) & F.col("vector").isNotNull()).groupBy("field").agg(F.min("vector").alias("vector"))
    return {r["field"]: list(r["vector"]) for r in one.orderBy("field").collect()}


def lexical_bonus(content: Column | str) -> Column:
    return F.when(~has(content, AMOUNT), 0.0).when(has(content, PROJECT_VALUE), 0.3).otherwise(0.15)


def add_lexical_bonus(rows: DataFrame) -> DataFrame:
    return compute(rows, bonus=lexical_bonus("content"))


def topk_by_field(scores: DataFrame, bonus: DataFrame | None = None, top_k: dict[str, int] | None = None) -> DataFrame:
    """Best chunks per notice and field; ties by id. ``bonus`` may also be a column of the scores."""
    ks = {**FIELD_TOP_K, **(top_k or {})}
    k = F.lit(DEFAULT_TOP_K)
    for name, n in ks.items():
        k = F.when(F.col("field") == name, n).otherwise(k)
    k = F.greatest(F.lit(5), F.least(F.lit(300), k))
    if bonus is not None:
        scores = scores.join(bonus.select("notice_id", "id", "bonus"), ["notice_id", "id"], "left")
    if "bonus" in scores.columns:
        extra = F.when(F.col("field") == "valor_projeto", F.coalesce("bonus", F.lit(0.0))).otherwise(0.0)
        scores = scores.withColumn("score", F.col("score") + extra).drop("bonus")
    w = W.partitionBy("notice_id", "field").orderBy(F.desc("score"), "id")
    ceiling = min(300, max(5, max([DEFAULT_TOP_K, *ks.values()])))
    # the constant ceiling lets each task prune before the shuffle; the field's own k follows
    ranked = scores.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= ceiling)
    return ranked.where(F.col("rn") <= k)


def file_name(rows: DataFrame) -> Column:
    """The chunk's file, else the file its metadata name, else its own id."""
    return F.coalesce(*[none_if_blank(c) for c in ("file_id", "meta_file_id") if c in rows.columns], F.col("id").cast("string"))


def chunk_block(rows: DataFrame) -> Column:
    """Header line and text of a chunk inside a context."""
    fid = file_name(rows)
    index = F.coalesce(F.col("order_index").cast("string"), F.lit("?"))
    return F.concat(F.lit("--- Documento "), head(fid, 12), F.lit(" / chunk "), index, F.lit(" ---\n"), strip("content"))


def with_blocks(ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    texts = chunks.select("id", "file_id", F.col("metadata.file_id").alias("meta_file_id"), F.col("metadata.chunk_index").alias("order_index"), "content")
    rows = ranked.join(texts, "id")
    return compute(rows, piece=chunk_block(rows)).drop("content")


def _joined(order: str, piece: str = "piece") -> Column:
    parts = F.array_sort(F.collect_list(F.struct(order, piece)))
    return F.array_join(F.transform(parts, lambda x: x[piece]), "\n\n")


def pack_context_by_score(blocks: DataFrame, budget: int = 3000) -> DataFrame:
    """Best-first blocks while they fit; a first block too long alone is cut."""
    w = W.partitionBy("notice_id", "field").orderBy("rn").rowsBetween(W.unboundedPreceding, 0)
    used = F.sum(F.length("piece") + 2).over(w) - 2
    kept = blocks.withColumn("used", used).where((F.col("used") <= budget) | (F.col("rn") == 1))
    kept = kept.withColumn("piece", F.substring("piece", 1, budget))
    return kept.groupBy("notice_id", "field").agg(_joined("rn").alias("context"), F.count("*").alias("pieces"), F.min_by("id", "rn").alias("first_id"))


def pack_context_reading(blocks: DataFrame, budget: int = 3000) -> DataFrame:
    """The same chunks in reading order, cut at the budget."""
    w = W.partitionBy("notice_id", "field").orderBy(F.coalesce("order_index", F.lit(-1)), "id")
    b = blocks.withColumn("ro", F.row_number().over(w))
    used = F.sum(F.length("piece") + 2).over(w.rowsBetween(W.unboundedPreceding, 0)) - F.length("piece") - 2
    # blocks whose separator already starts beyond the budget cannot be seen
    b = b.withColumn("begin", used).where(F.col("begin") - 2 < budget)
    return b.groupBy("notice_id", "field").agg(
        F.substring(_joined("ro"), 1, budget).alias("context"), F.count("*").alias("pieces")
    )


def sample_context(ordered: DataFrame, rows: int = 100, budget: int = 6000) -> DataFrame:
    """First ``rows`` chunks in reading order as one context, cut at the budget."""
    s = ordered.where(F.col("pos") <= rows)
    s = compute(s, piece=F.concat(F.lit("--- Documento "), head(file_name(s), 12), F.lit(" ---\n"), strip("content")))
    return s.groupBy("notice_id").agg(F.substring(_joined("pos"), 1, budget).alias("context"))


def topk_batches(blocks: DataFrame, per_batch: int = 3, max_batches: int | None = None, max_chars: int = 3000) -> DataFrame:
    """All ranked chunks (or the first ``max_batches`` groups) in fixed groups, text cut at a request's budget."""
    if max_batches is not None:
        blocks = blocks.where(F.col("rn") <= per_batch * max_batches)
    b = blocks.withColumn("batch", F.floor((F.col("rn") - 1) / per_batch).cast("int"))
    return b.groupBy("notice_id", "field", "batch").agg(
        F.substring(_joined("rn"), 1, max_chars).alias("context"), F.count("*").alias("pieces"), F.min_by("id", "rn").alias("first_id")
    )


def scan_batches(ordered: DataFrame, per_batch: int = 3, max_chars: int = 3000, max_batches: int = 0) -> DataFrame:
    """Whole notice in reading order, greedy batches of few blocks and bounded text.

    The counter restarts with each batch, so this is a fold over a notice; it runs blockwise, on lengths alone, like the
    batches of a long file. ``ordered`` must hold chunks with text only, their positions without a gap.
    """
    rows = compute(ordered, piece=chunk_block(ordered)).select("notice_id", "id", "pos", "piece")
    lengths = rows.select(
        F.col("notice_id").cast("string").alias("file_id"), (F.col("pos") - 1).cast("int").alias("chunk_index"), (F.length("piece") + 2).alias("len")
    )
    batches = blockwise_batches(lengths, per_batch, max_chars + 2, BLOCK)
    batches = batches.select(F.col("file_id").alias("notice_id"), (F.col("chunk_index") + 1).alias("pos"), F.col("batch_id").alias("batch"))
    numbered = rows.join(batches, ["notice_id", "pos"])
    if max_batches:
        numbered = numbered.where(F.col("batch") < max_batches)
    return numbered.groupBy("notice_id", "batch").agg(
        F.substring(_joined("pos"), 1, max_chars).alias("context"), F.count("*").alias("pieces"), F.min_by("id", "pos").alias("first_id")
    )


def sliding_windows(lengths: DataFrame, size: int = 3000, overlap: int = 1000, max_windows: int | None = None) -> DataFrame:
    """Overlapping windows over each notice's text until its end (or the maximum)."""
    step = max(1, size - overlap)
    last = F.ceil(F.greatest(F.col("plain_len") - size, F.lit(0)) / F.lit(step)).cast("int")
    idx = F.sequence(F.lit(0), last if max_windows is None else F.least(last, F.lit(max_windows - 1)))
    w = lengths.where("plain_len > 0").select("notice_id", "plain_len", F.explode(idx).alias("window_index"))
    return w.select("notice_id", "window_index", (F.col("window_index") * step).alias("w_start"),
                    F.least(F.col("plain_len"), F.col("window_index") * step + size).alias("w_end"))


def spread_starts(length: Column, size: Column, windows: Column) -> Column:
    """Window starts from the first to the last possible, evenly spread and strictly rising."""
    top = length - size
    raw = F.transform(
        F.sequence(F.lit(0), F.greatest(windows - 1, F.lit(1))), lambda i: F.floor(top * i / (windows - 1) + F.lit(0.5)).cast("long")
    )
    return F.when((length <= size) | (windows <= 1), F.array(F.lit(0).cast("long"))).otherwise(F.array_sort(F.array_distinct(raw)))


def spread_windows(lengths: DataFrame, size: int, windows: int) -> DataFrame:
    starts = spread_starts(F.col("plain_len"), F.lit(size), F.lit(windows))
    w = lengths.where("plain_len > 0").select("notice_id", "plain_len", F.posexplode(starts).alias("window_index", "w_start"))
    return w.withColumn("w_end", F.least(F.col("plain_len"), F.col("w_start") + size)).drop("plain_len")


def window_plan(lengths: DataFrame, large: int = 200_000, huge: int = 400_000, size: int = 3000, overlap: int = 1000) -> DataFrame:
    """Window parameters and need per (notice, field), from text size and the ranked wave's outcome.

    ``lengths``: notice_id, field, plain_len, topk_finished, topk_timed_out.
    """
    boolean = F.col("field").isin("is_researcher", "is_company")
    n = F.least(
        F.lit(24),
        F.when(F.col("topk_finished"), 6).otherwise(24),
        F.when(F.col("topk_timed_out"), F.when(boolean, 2).otherwise(3)).otherwise(24),
        F.when(F.col("plain_len") >= huge, 8).when(F.col("plain_len") >= large, 10).otherwise(24),
    )
    skip_large = F.col("topk_finished") & (F.col("plain_len") >= large) & ~F.col("field").isin("timeline_estimada", "prazo_inscricao")
    needed = F.col("topk_timed_out") | ~((boolean & F.col("topk_finished")) | skip_large)
    return lengths.select(
        "*",
        F.lit(size).alias("window_size"),
        F.when(F.col("plain_len") >= huge, 0).otherwise(overlap).alias("overlap"),
        n.alias("max_windows"),
        (F.col("plain_len") >= large).alias("spread"),
        needed.alias("scan_needed"),
    )


def subsample_long(ordered: DataFrame, max_chars: int = 320_000) -> DataFrame:
    """Chunks a window scan reads: all of a short notice; head, tail and stepped middle of a long one."""
    rows = compute(ordered.select("notice_id", "id", "pos", "content"), n=F.length(strip("content"))).drop("content")
    rows = rows.withColumn("w", F.when(F.col("n") > 0, F.col("n") + 2).otherwise(0))
    sizes = rows.groupBy("notice_id").agg(F.count("*").alias("total"), (F.sum("w") - 2).alias("chars"))
    cut = F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(0.22))).cast("int")
    rows = rows.join(sizes.withColumn("cut", cut), "notice_id")
    rows = rows.withColumn(
        "part", F.when(F.col("chars") <= max_chars, "all").when(F.col("pos") <= F.col("cut"), "head").when(F.col("pos") > F.col("total") - F.col("cut"), "tail").otherwise("middle")
    )
    is_ = lambda p: F.sum(F.when(F.col("part") == p, F.col("w")).otherwise(0))
    parts = rows.where("part <> 'all'").groupBy("notice_id").agg(
        (is_("head") - 2).alias("head_chars"), (is_("tail") - 2).alias("tail_chars"), F.greatest(is_("middle") - 2, F.lit(0)).alias("mid_chars"),
        F.count_if(F.col("part") == "middle").alias("mid_n"),
    )
    budget = F.greatest(F.lit(0), F.lit(max_chars) - F.col("head_chars") - F.col("tail_chars"))
    avg = F.greatest(F.lit(80), F.floor(F.col("mid_chars") / F.nullif(F.col("mid_n"), F.lit(0))))
    step = F.greatest(F.lit(1), F.ceil(F.col("mid_n") / F.greatest(F.lit(1), F.ceil(budget / avg))))
    rows = rows.join(parts.withColumn("budget", budget).withColumn("step", step), "notice_id", "left")
    on_step = F.pmod(F.col("pos") - F.col("cut") - 1, F.col("step")) == 0
    cand = rows.where((F.col("part") != "middle") | (on_step & (F.col("budget") > 0)))
    # a stepped chunk is read while what was picked before it leaves room for the tail
    w = W.partitionBy("notice_id", "part").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("w").over(w), F.lit(0)) + F.col("head_chars")
    out = cand.withColumn("before", before)
    return out.where((F.col("part") != "middle") | (F.col("before") < max_chars - F.col("tail_chars"))).select("notice_id", "id", "pos", "part")


def keyword_rank_context(rows: DataFrame, terms: Sequence[tuple[str, int]], top: int, budget: int, positive: bool = True,
                         base: DataFrame | None = None) -> DataFrame:
    """Chunks by weighted terms, best ``top`` appended to the notice's base text while they fit."""
    score = F.lit(0)
    for pattern, weight in terms:
        score = score + F.when(has("content", pattern), weight).otherwise(0)
    r = compute(rows.where(strip("content") != ""), kw=score, n=F.length("content") + 5)
    if positive:
        r = r.where("kw > 0")
    order = W.partitionBy("notice_id").orderBy(F.desc("kw"), "id")
    r = r.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= top)
    if base is not None:
        r = r.join(base.select("notice_id", "base"), "notice_id", "left")
    start = F.coalesce(F.col("base"), F.lit("")) if base is not None else F.lit("")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.length(start)
    r = r.withColumn("before", before).withColumn("start", start)
    # the first chunk that does not fit ends the context; sums only grow, so later ones may not re-enter
    r = r.withColumn("over", F.max(F.when(F.col("before") + F.length("content") > budget, 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    kept = r.where("over = 0").withColumn("piece", F.concat(F.lit("\n---\n"), "content"))
    parts = F.array_sort(F.collect_list(F.struct("rn", "piece")))
    text = F.array_join(F.transform(parts, lambda x: x["piece"]), "")
    out = kept.groupBy("notice_id").agg(F.concat(F.first("start"), text).alias("context"), F.count("*").alias("pieces"))
    if base is None:
        return out
    return base.join(out, "notice_id", "left").select(
        "notice_id", F.coalesce("context", "base").alias("context"), F.coalesce("pieces", F.lit(0)).alias("pieces")
    )


# Wording of the retrieval query and of the request, per field.
QUERY_HINTS = {
    "valor_projeto": "Foco: valor máximo/mínimo por proposta ou por projeto, teto por projeto, faixas de apoio, número de projetos apoiados, valor global/total da chamada, dotação, R$, bolsas, contrapartida.",
    "prazo_inscricao": "Foco: prazos e datas de inscrição/submissão, encerramento, cronograma, datas DD/MM/AAAA, YYYY-MM-DD, 'até', 'prazo'.",
    "localizacao": "Foco: abrangência, local/estado/município, elegibilidade por território, sede, execução do projeto.",
    "vagas": "Foco: número de vagas/bolsas, quantitativo, beneficiários, seleção, cadastro de reserva.",
    "is_researcher": "Foco: se pesquisadores/ICT/universidades são elegíveis; requisitos de titulação, vínculo, Lattes.",
    "is_company": "Foco: se empresas/CNPJ/startups/MEI são elegíveis; porte, faturamento, CNAE, requisitos.",
    "sobre_programa": "Foco: objetivos, público-alvo, escopo, eixos temáticos, modalidades, resumo do edital/programa.",
    "criterios_elegibilidade": "Foco: critérios/requisitos, documentação, impedimentos, contrapartidas, habilitação, quem pode/quem não pode.",
    "timeline_estimada": "Foco: etapas/fases do processo (inscrição, submissão, análise, homologação, recursos) com prazos/datas.",
}
QUERY_PREFIX = "[CONTEXTO PARA BUSCA — alinhado ao pipeline process-edital-info]"
QUERY_TASK = "Tarefa: recupere trechos do edital mais relevantes para responder com evidência."
PROMPT_HEAD = (
    "Você extrai informações de editais usando SOMENTE o conteúdo abaixo.",
    "Retorne APENAS UM OBJETO JSON VÁLIDO (sem markdown, sem texto extra, sem explicações).",
    "A sua resposta DEVE ser parseável por JSON.parse. Se não for, será descartada.",
    "Se não houver evidência suficiente no conteúdo, use null.",
    "As linhas Edital/Campo abaixo são só contexto: nunca as repita dentro do valor extraído.",
)


def notice_line() -> Column:
    na = lambda c: F.coalesce(none_if_blank(c), F.lit("N/A"))
    return F.concat(F.lit("Edital: "), na("numero"), F.lit(" — "), blank("titulo"), F.lit(" ("), na("fonte"), F.lit(")"))


def build_field_queries(notices: DataFrame) -> DataFrame:
    """Retrieval query text per (notice, field): what gets embedded."""
    fields = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(QUERY_HINTS[n]).alias("hint")) for n in FIELDS])
    q = notices.select(F.col("id").alias("notice_id"), notice_line().alias("base"), F.inline(fields))
    return q.select(
        "notice_id", "field",
        F.concat_ws(
            "\n", F.lit(QUERY_PREFIX), F.concat(F.lit("Campos relacionados: "), "field"),
            F.concat(F.lit("Perguntas exemplo: Que informações do edital respondem a este campo? "), "hint"), F.lit(""), "base",
            F.concat(F.lit("Campo: "), "field"), F.lit(QUERY_TASK), "hint",
        ).alias("query_text"),
    )


def _per_field(texts: dict[str, str]) -> Column:
    out = F.lit("")
    for name, text in texts.items():
        out = F.when(F.col("field") == name, text).otherwise(out)
    return out


def build_requests(contexts: DataFrame, notices: DataFrame, stage: str) -> DataFrame:
    """Request rows (notice_id, field, stage, batch, prompt) for contexts (notice_id, field, batch, context)."""
    rule = F.concat(F.lit('- Responda em UMA linha JSON, exatamente com a chave "'), "field", F.lit('"'))
    n = notices.select(F.col("id").cast("string").alias("notice_id"), notice_line().alias("base"))
    prompt = F.concat_ws(
        "\n", *[F.lit(x) for x in PROMPT_HEAD], F.lit(""), "base", F.lit(""), F.concat(F.lit("Campo: "), "field"),
        F.concat(F.lit("Formato esperado (exemplo): "), _per_field({f: prompts.example(f) for f in FIELDS})), F.lit(""),
        F.lit("REGRAS CRÍTICAS:"), rule, F.lit("- Não inclua outras chaves"), F.lit("- Não inclua quebras de linha fora do JSON"),
        none_if_blank(_per_field({"valor_projeto": "\n".join(prompts.VALUE_RULES)})), F.lit(""), F.lit("CONTEÚDO:"), F.coalesce(none_if_blank("context"), F.lit("(vazio)")),
    )
    return contexts.join(n, "notice_id").select("notice_id", "field", F.lit(stage).alias("stage"), "batch", prompt.alias("prompt"))


# What an audit request quotes of its notice.
HEADINGS = ("numero", "titulo", "fonte")


def with_headings(notices: DataFrame) -> DataFrame:
    """Notices joined with the headings of all notices of their id: as many rows as those, none for a null id.

    An id that occurs once meets only itself, so ids are counted and only the headings of shared ones are looked up; no notice is dealt out for it.
    """
    known = notices.where("id IS NOT NULL")
    # stored, so that their sizes are known: few shared ids, the usual case, are sent to where the notices are
    shared = materialize(known.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "shared-ids")
    twins = materialize(known.select("id", F.struct(*HEADINGS).alias("_twin")).join(shared, "id", "left_semi"), "twins")
    heads = {c: F.when(F.col("_twin").isNull(), F.col(c)).otherwise(F.col(f"_twin.{c}")) for c in HEADINGS}
    return known.join(twins, "id", "left").withColumns(heads).drop("_twin")


def build_audit_requests(targets: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """Audit request per target (id, field, before, optional source, snippet and document_ids); the document text follows the prompt.

    Without ``notices`` the targets carry HEADINGS themselves.
    """
    t = targets if notices is None else targets.join(notices.select("id", *HEADINGS), "id")
    for c, kind in (("source", "string"), ("snippet", "string"), ("document_ids", "array<string>")):
        if c not in t.columns:
            t = t.withColumn(c, F.lit(None).cast(kind))
    known = F.filter("document_ids", lambda x: x != "")
    ids = F.when(F.size(known) > 0, F.concat(F.lit("\nIDs em documents (linhas da extração): "), F.array_join(known, ", "))).otherwise("")
    boolean = F.col("field").isin("is_researcher", "is_company", "timeline_estimada")
    quoted = F.regexp_replace(F.to_json(F.array("before")), r"^\[|\]$", "")
    before = F.when(F.col("before").isNull(), "null").when(boolean, F.col("before")).otherwise(quoted)
    evidence = F.when(
        F.trim(blank("snippet")) != "", F.concat(F.lit("Trecho usado na extração (origem: "), blank("source"), F.lit("):\n"), F.col("snippet"), ids)
    ).otherwise(F.lit(prompts.NO_EVIDENCE))
    prompt = F.concat_ws(
        "\n", *[F.lit(x) for x in prompts.AUDIT_HEAD],
        F.concat(F.lit("Edital: "), F.coalesce(none_if_blank("numero"), F.lit("N/A")), F.lit(" — "), blank("titulo")), F.concat(F.lit("Fonte: "), blank("fonte")), F.lit(""),
        F.concat(F.lit("Campo: "), "field"), F.concat(F.lit("Valor atual (extração): "), before), F.lit(""), evidence, F.lit(""),
        F.lit("Orientação do campo:"), _per_field(prompts.GUIDANCE), F.lit(""), F.lit("Formato de saída: APENAS JSON válido (uma linha se possível) com:"),
        F.concat(F.lit('- a chave do campo "'), "field", F.lit('" com o valor final (tipo correto: string, boolean, objeto timeline, ou null)')),
        F.lit('- a chave "_audit" com objeto { "decision": "accept"|"replace"|"reject", "reason": "breve, PT-BR" }'),
        F.concat(F.lit('Exemplo de chaves: "'), "field", F.lit('" e "_audit".')),
        F.concat(F.lit("Referência de tipo/estrutura: "), _per_field({f: prompts.example(f, audit=True) for f in FIELDS})),
    )
    return t.select(F.col("id").alias("notice_id"), "field", prompt.alias("prompt"))


def build_stipend_requests(contexts: DataFrame) -> DataFrame:
    """Stipend question over each notice's keyword context (notice_id, context)."""
    return contexts.select("notice_id", F.lit("valor_bolsa").alias("field"), F.concat(F.lit(prompts.STIPEND_PROMPT), "context").alias("prompt"))
