"""Chunk index: queue, health, cleaning, chunking, enrichment, batching, replacement."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions.frames import compute
from ..functions.vectors import finite
from ..functions.text import blank, grab, none_if_blank, squish, strip

# Markers and labels of the stored chunk text.
CONTEXT_MARK = "[CONTEXTO PARA BUSCA — alinhado ao pipeline process-edital-info]"
EXCERPT_MARK = "[TRECHO DO EDITAL]"
ENRICHMENT_SCHEMA = "struct<tipos_de_pergunta: array<string>, campos_relacionados: array<string>, perguntas_exemplo: array<string>>"
#: Chunks of one file folded in one task; longer files are cut into blocks of this many.
BLOCK = 4096


def file_key() -> Column:
    return strip(F.coalesce(none_if_blank("file_id"), F.col("id").cast("string")))


def _first_per_file(attachments: DataFrame) -> DataFrame:
    keyed = attachments.withColumn("file_key", file_key()).where("file_key <> ''")
    cols = keyed.columns
    first = keyed.groupBy("file_key").agg(F.min_by(F.struct(*cols), F.struct("edital_id", "id")).alias("r"))
    return first.select("r.*")


def build_queue(attachments: DataFrame, limit: int | None = None, all_files: bool = False) -> DataFrame:
    """Unprocessed files in notice order, one row per file key."""
    todo = attachments if all_files else attachments.where(~F.coalesce("is_processed", F.lit(False)))
    queue = _first_per_file(todo)
    return queue.orderBy("edital_id", "id").limit(limit) if limit else queue


def requeue_stale(queue: DataFrame, attachments: DataFrame, health: DataFrame, batch: int | None = None, newest: int | None = None) -> DataFrame:
    """Queue plus the processed files whose index is incomplete; newest first where ``batch`` or ``newest`` limits them."""
    order = [F.desc("edital_id"), F.desc("id")]
    marked = attachments.where("is_processed")
    if newest is not None:
        marked = marked.orderBy(*order).limit(newest)
    keyed = marked.withColumn("file_key", file_key()).where("file_key <> ''")
    first = keyed.groupBy("file_key").agg(F.max_by(F.struct(*keyed.columns), F.struct("edital_id", "id")).alias("r")).select("r.*")
    healthy = health.where("fully_indexed").select(F.col("file_id").alias("file_key"))
    stale = first.join(queue.select("file_key"), "file_key", "left_anti").join(healthy, "file_key", "left_anti")
    if batch is not None:
        stale = stale.orderBy(*order).limit(batch)
    return queue.unionByName(stale.select(*queue.columns))


def index_health(chunks: DataFrame, min_chars: int = 50) -> DataFrame:
    """Per file: chunks, with content, with embedding, missing, and whether fully indexed."""
    embedded = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    h = chunks.groupBy("file_id").agg(
        F.count("*").alias("total"),
        F.count_if(F.length(strip("content")) >= min_chars).alias("with_content"),
        F.count_if(embedded).alias("with_embedding"),
    )
    return h.withColumn("missing", F.expr("total - with_embedding")).withColumn(
        "fully_indexed", F.expr("total > 0 AND with_content > 0 AND missing = 0")
    )


def purge_partial_chunks(chunks: DataFrame, cutoff: datetime | None = None, rebuilt: DataFrame | None = None) -> DataFrame:
    """Chunks that stay: those without embedding go if older than ``cutoff`` or of a file about to be rebuilt."""
    out = chunks
    if cutoff is not None:
        out = out.where(~(F.col("embedding").isNull() & F.coalesce(F.col("criado_em") < F.lit(cutoff), F.lit(False))))
    if rebuilt is not None:
        # only the rows without embedding take part in the join
        files = rebuilt.select("file_id").distinct()
        partial = out.where("embedding IS NULL").join(files, "file_id", "left_anti")
        out = out.where("embedding IS NOT NULL").unionByName(partial)
    return out


def _sanitized(c: Column | str) -> Column:
    t = F.regexp_replace(blank(c), r"[\x00-\x1f&&[^\t\n\r]]", " ")
    return squish(F.replace(t, F.lit("\\"), F.lit(" ")))


def clean_text(documents: DataFrame, column: str = "text", min_chars: int = 50) -> DataFrame:
    """Whitespace collapsed, control characters and backslashes dropped, short texts rejected."""
    return compute(documents, **{column: _sanitized(column)}).where(F.length(column) >= min_chars)


def chunk_documents(documents: DataFrame, key: str = "doc_id", column: str = "text", size: int = 800, overlap: int = 200) -> DataFrame:
    """Overlapping chunks of each text with a dense index; pure row expressions, no shuffle."""
    step = max(1, size - overlap)
    text = compute(documents.select(key, column), t=squish(column)).where("t <> ''")
    # a cut of collapsed text needs no more than its ends trimmed, unless the text holds what is to be dropped
    text = compute(text, dirty=F.col("t").rlike(r"[\x00-\x1f\\]"))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((F.length("t") - size) / F.lit(step)).cast("int"), F.lit(0)))

    def piece(i):
        cut = F.substr(F.col("t"), i * step + 1, F.lit(size))
        return F.when(F.col("dirty"), _sanitized(cut)).otherwise(F.trim(cut))

    pieces = F.transform(starts, piece)
    return text.select(key, F.posexplode(F.filter(pieces, lambda c: c != "")).alias("chunk_index", "content"))


def parse_json_block(raw: Column | str) -> Column:
    """Outermost braces of a fenced or plain answer."""
    t = strip(raw)
    body = F.coalesce(grab(t, r"```(?:json)?\s*([\s\S]*?)```"), t)
    return none_if_blank(F.regexp_extract(body, r"(?s)(\{.*\})", 1))


def parse_enrichment(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Question types, known related fields and sample questions of each answer."""
    parsed = compute(responses, e=F.from_json(parse_json_block(raw), ENRICHMENT_SCHEMA, {"mode": "PERMISSIVE"}),
                     ok=F.try_parse_json(parse_json_block(raw)).isNotNull())
    empty = F.array().cast("array<string>")
    names = F.array(*[F.lit(x) for x in FIELDS])
    return parsed.select(
        *[c for c in responses.columns],
        (~F.col("ok")).alias("enrich_failed"),
        F.when(
            F.col("ok"),
            F.struct(
                F.coalesce("e.tipos_de_pergunta", empty).alias("tipos_de_pergunta"),
                F.filter(F.coalesce("e.campos_relacionados", empty), lambda x: F.array_contains(names, x)).alias("campos_relacionados"),
                F.coalesce("e.perguntas_exemplo", empty).alias("perguntas_exemplo"),
            ),
        ).alias("enrichment"),
    )


def compose_chunk_text(chunks: DataFrame, enrichments: DataFrame, max_enriched: int = 0, embed_chars: int = 512) -> DataFrame:
    """Stored text, retrieval text and metadata of each chunk; plain when enrichment failed or was skipped."""
    c = chunks.join(enrichments.select("file_id", "chunk_index", "enrichment"), ["file_id", "chunk_index"], "left")
    skipped = (F.col("chunk_index") >= max_enriched) if max_enriched > 0 else F.lit(False)
    use = F.col("enrichment").isNotNull() & ~skipped

    def listed(name: str, sep: str, none: str) -> Column:
        return F.coalesce(none_if_blank(F.array_join(f"enrichment.{name}", sep)), F.lit(none))

    header = F.concat_ws(
        "\n",
        F.lit(CONTEXT_MARK),
        F.concat(F.lit("Tipos de pergunta: "), listed("tipos_de_pergunta", "; ", "(não especificado)")),
        F.concat(F.lit("Campos relacionados: "), listed("campos_relacionados", ", ", "(nenhum)")),
        F.concat(F.lit("Perguntas exemplo: "), listed("perguntas_exemplo", " | ", "(nenhuma)")),
    )
    full = F.concat_ws("\n", "header", F.lit(""), F.lit(EXCERPT_MARK), strip("content"))
    return c.withColumn("skipped", skipped).withColumn("header", F.when(use, header)).select(
        "file_id",
        "edital_id",
        "chunk_index",
        F.when(F.col("header").isNotNull(), full).otherwise(F.col("content")).alias("content"),
        F.coalesce("header", "content").alias("retrieval_text"),
        F.struct(
            "file_id",
            F.col("edital_id").cast("string").alias("edital_id"),
            "chunk_index",
            F.col("content").alias("chunk_plain_preview"),
            F.when(F.col("header").isNotNull(), F.col("enrichment")).alias("enrichment"),
            (F.col("enrichment").isNull() & ~F.col("skipped")).alias("enrich_failed"),
            F.col("skipped").alias("enrich_skipped_llm"),
            F.lit(embed_chars).alias("embed_truncates_at"),
        ).alias("metadata"),
    )


def retrieval_text(content: Column | str) -> Column:
    t = strip(content)
    at = F.instr(t, EXCERPT_MARK)
    return F.when(at > 1, strip(F.substr(t, F.lit(1), at - 1))).otherwise(t)


def split_retrieval_text(chunks: DataFrame) -> DataFrame:
    return compute(chunks, retrieval_text=retrieval_text("content"))


def _small_file_batches(items: DataFrame, max_items: int, max_chars: int) -> DataFrame:
    """Fold over one file's lengths (at most BLOCK of them)."""
    seq = F.array_sort(F.collect_list(F.struct("chunk_index", "len")))
    start = F.struct(
        F.lit(0).alias("items"), F.lit(0).alias("chars"), F.lit(0).cast("long").alias("batch"), F.array().cast("array<bigint>").alias("ids")
    )

    def step(acc, x):
        close = (acc["items"] > 0) & ((acc["items"] >= max_items) | (acc["chars"] + x["len"] > max_chars))
        batch = F.when(close, acc["batch"] + 1).otherwise(acc["batch"])
        return F.struct(
            F.when(close, 1).otherwise(acc["items"] + 1).alias("items"),
            F.when(close, x["len"]).otherwise(acc["chars"] + x["len"]).alias("chars"),
            batch.alias("batch"),
            F.array_append(acc["ids"], batch).alias("ids"),
        )

    folded = items.groupBy("file_id").agg(seq.alias("xs")).select("file_id", "xs", F.aggregate("xs", start, step)["ids"].alias("ids"))
    return folded.select("file_id", F.inline(F.arrays_zip(F.col("xs.chunk_index").alias("chunk_index"), F.col("ids").alias("batch_id"))))


def blockwise_batches(items: DataFrame, max_items: int, max_chars: int, block: int) -> DataFrame:
    """The same fold for files of any length, without any task seeing a whole file.

    A batch holds at most ``max_items`` chunks, so the first batch that starts inside a block starts at
    one of its first ``max_items`` chunks. Each block is folded once per such entry (reading the next
    block's first chunks as margin); chaining the blocks' small entry-to-exit tables gives every block's
    true entry and first batch number, and a second pass numbers the chunks.
    """
    import numpy as np
    import pandas as pd

    def nexts(lens: np.ndarray) -> np.ndarray:
        cum = np.concatenate([[0], np.cumsum(lens)])
        fit = np.searchsorted(cum, cum[:-1] + max_chars, side="right") - 1
        i = np.arange(len(lens))
        return np.minimum(np.maximum(fit, i + 1), i + max_items)

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk_index")
        own = int((~pdf["margin"]).sum())
        nxt = nexts(pdf["len"].to_numpy())
        rows = []
        for entry in range(max_items):
            at, n = entry, 0
            while at < own:
                at, n = int(nxt[at]), n + 1
            rows.append((pdf["file_id"].iloc[0], int(pdf["block"].iloc[0]), entry, at - own, n))
        return pd.DataFrame(rows, columns=["file_id", "block", "entry", "exit", "batches"])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.set_index(["block", "entry"]).sort_index()
        entry, first, rows = 0, 0, []
        for b in sorted(pdf["block"].unique()):
            rows.append((pdf["file_id"].iloc[0], int(b), entry, first))
            r = table.loc[(b, entry)]
            entry, first = int(r["exit"]), first + int(r["batches"])
        return pd.DataFrame(rows, columns=["file_id", "block", "entry", "first"])

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk_index").reset_index(drop=True)
        nxt = nexts(pdf["len"].to_numpy())
        own = int((~pdf["margin"]).sum())
        at, batch = int(pdf["entry"].iloc[0]), int(pdf["first"].iloc[0])
        ids = np.full(len(pdf), batch - 1, dtype="int64")
        while at < own:
            ids[at:] = batch
            at, batch = int(nxt[at]), batch + 1
        out = pdf.assign(batch_id=ids)
        return out.loc[~out["margin"], ["file_id", "chunk_index", "batch_id"]]

    own = items.withColumn("block", F.floor(F.col("chunk_index") / block)).withColumn("margin", F.lit(False))
    margin = own.where((F.col("chunk_index") % block < max_items) & (F.col("block") > 0))
    cut = own.unionByName(margin.withColumn("block", F.col("block") - 1).withColumn("margin", F.lit(True)))
    table = cut.groupBy("file_id", "block").applyInPandas(exits, "file_id string, block long, entry int, exit int, batches long")
    starts = table.groupBy("file_id").applyInPandas(chain, "file_id string, block long, entry int, first long")
    return cut.join(starts, ["file_id", "block"]).groupBy("file_id", "block").applyInPandas(number, "file_id string, chunk_index int, batch_id long")


def pack_embed_batches(chunks: DataFrame, text: str = "content", max_text: int = 512, max_items: int = 8, max_chars: int = 2048, block: int = BLOCK) -> DataFrame:
    """Greedy in-order batches per file: at most ``max_items`` texts and ``max_chars`` characters.

    ``chunk_index`` must be dense from 0 per file, as ``chunk_documents`` makes it.
    """
    items = chunks.select("file_id", "chunk_index", F.least(F.length(blank(text)), F.lit(max_text)).alias("len"))
    long_files = items.where(F.col("chunk_index") == block).select("file_id").distinct()
    small = _small_file_batches(items.join(long_files, "file_id", "left_anti"), max_items, max_chars)
    large = blockwise_batches(items.join(long_files, "file_id", "left_semi"), max_items, max_chars, block)
    return small.unionByName(large)


def coerce_vector(raw: Column | str) -> Column:
    """Vector from JSON text, flat or in any number of one-vector lists; shorter than four is no vector."""
    inner = F.regexp_replace(F.regexp_replace(strip(raw), r"^(?:\[\s*)+(?=\[)", ""), r"\](?:\s*[,\]][\s\S]*)?$", "]")
    v = F.from_json(inner, "array<double>")
    return F.when(F.size(v) >= 4, v)


def check_embeddings(embeddings: DataFrame, dimension: int, column: str = "embedding") -> DataFrame:
    """Counts of vectors that are present, long enough, finite and of the expected dimension."""
    v = F.col(column)
    ok = (F.size(v) >= 4) & finite(v) & (F.size(v) == dimension)
    return embeddings.agg(
        F.count("*").alias("rows"),
        F.count_if(v.isNotNull()).alias("present"),
        F.count_if(F.coalesce(F.size(v) >= 4, F.lit(False))).alias("long_enough"),
        F.count_if(F.coalesce(finite(v), F.lit(False))).alias("finite"),
        F.count_if(F.coalesce(F.size(v) == dimension, F.lit(False))).alias("right_dimension"),
        F.count_if(F.coalesce(ok, F.lit(False))).alias("valid"),
    )


def replace_file_chunks(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Next snapshot: files with a complete set of new embeddings get exactly their new chunks."""
    complete = new.groupBy("file_id").agg(F.bool_and(F.col("embedding").isNotNull()).alias("ok")).where("ok").select("file_id")
    kept = stored.join(complete, "file_id", "left_anti")
    return kept.unionByName(new.join(complete, "file_id", "left_semi"), allowMissingColumns=True)


def backfill_targets(chunks: DataFrame, limit: int | None = None) -> DataFrame:
    """Embedded chunks without a question embedding, with the text to embed."""
    rows = chunks.where("embedding IS NOT NULL AND embedding_perguntas IS NULL").select("id", "content")
    rows = rows.orderBy("id").limit(limit) if limit else rows
    return compute(rows, retrieval_text=retrieval_text("content")).drop("content")


def mark_processed(attachments: DataFrame, health: DataFrame) -> DataFrame:
    """Processed flag of every attachment from its file's health."""
    ok = health.select(F.col("file_id").alias("file_key"), "fully_indexed")
    keyed = attachments.withColumn("file_key", file_key())
    return keyed.join(ok, "file_key", "left").withColumn("is_processed", F.coalesce("fully_indexed", F.lit(False))).drop("file_key", "fully_indexed")


def summarize_processing(health: DataFrame, queue: DataFrame) -> DataFrame:
    """Totals of a run over the queued files, and its severity."""
    per_file = queue.select("file_key").join(health.withColumnRenamed("file_id", "file_key"), "file_key", "left")
    t = per_file.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_chunks"),
        F.coalesce(F.sum("with_embedding"), F.lit(0)).alias("embeddings_ok"),
        F.count_if(~F.coalesce("fully_indexed", F.lit(False))).alias("pdf_failures"),
    )
    warn = (F.col("pdf_failures") > 0) | ((F.col("total_chunks") > 0) & (F.col("embeddings_ok") == 0))
    return t.withColumn("severity", F.when(warn, "warn").otherwise("info"))
