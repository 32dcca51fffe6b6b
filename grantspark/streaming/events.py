"""Domain events: parsing, routing, messages, run events and incremental work.

All but the last are plain DataFrame functions, so the same code serves a stream and a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank, none_if_blank, strip

EVENT_SCHEMA = (
    "struct<id: string, name: string, severity: string, message: string, at: string, trace: struct<trace_id: string, span_id: string>, props: string,"
    " error: struct<type: string, message: string, stack: string>, actor: struct<user_id: string, email: string>, request: struct<method: string, path: string>,"
    " component: string>"
)
# Severities, the ones the error route takes, and the mark of a shortened text.
SEVERITIES = ("info", "warn", "error", "fatal")
ERROR_SEVERITIES = ("error", "fatal")
CUT = "\n…(truncated)"
LOCAL_OFFSET = "-03:00"
#: Fixed value: the form of a time that readers of events accept.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:\d{2})$"


def parse_events(raw: DataFrame, column: str = "detail") -> DataFrame:
    """Typed event and the first reason it is not valid (NULL when it is)."""
    e = raw.withColumn("event", F.from_json(column, EVENT_SCHEMA)).withColumn("at", F.try_to_timestamp(F.col("event.at")))
    empty = lambda c: strip(f"event.{c}") == ""
    json = F.try_parse_json(column)

    def text_at(path: str) -> Column:
        """Absent, null or a JSON string."""
        kind = F.schema_of_variant(F.try_variant_get(json, path, "variant"))
        return F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))

    typed = [text_at(f"$.{c}") for c in ("id", "name", "severity", "message", "at", "component")]
    timed = F.coalesce(F.col("event.at").rlike(RFC3339), F.lit(True))
    malformed = json.isNull() | ~F.trim(column).startswith("{") | ~timed
    for ok in typed:
        malformed = malformed | ~ok
    invalid = (
        F.when(malformed, "malformed")
        .when(empty("id"), "missing id")
        .when(empty("name"), "missing name")
        .when(~blank("event.severity").isin(*SEVERITIES), "invalid severity")
        .when(empty("message"), "missing message")
        .when(F.col("at").isNull() | (F.year("at") <= 1), "missing at")
    )
    return e.withColumn("invalid", invalid)


def route_events(parsed: DataFrame) -> DataFrame:
    """One row per (event, route): everything to the notifier, valid errors also to the reporter."""
    report = F.col("invalid").isNull() & F.col("event.severity").isin(*ERROR_SEVERITIES)
    routes = F.array_compact(F.array(F.lit("notifier"), F.when(report, F.lit("reporter"))))
    return parsed.withColumn("route", F.explode(routes))


def _clip(c: Column, limit: int | None) -> Column:
    return c if limit is None else F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(CUT))).otherwise(c)


def _pair(label: str, a: str, b: str) -> Column:
    some = (blank(a) != "") | (blank(b) != "")
    return F.when(some, F.concat(F.lit(f"{label}: "), blank(a), F.lit(" "), blank(b)))


def _labelled(label: str, c: str) -> Column:
    return F.when(blank(c) != "", F.concat(F.lit(f"{label}: "), blank(c)))


def format_messages(routed: DataFrame, source: str | None = None, detail_type: str | None = None, raw: str = "detail", stack_chars: int | None = None, props_chars: int | None = None) -> DataFrame:
    """Message text per routed event; absent parts leave no line. Stacks and properties are whole unless limited."""
    e = "event."
    when = F.concat(F.lit("at: "), F.date_format(F.from_utc_timestamp("at", LOCAL_OFFSET), "dd/MM HH:mm:ss"))
    src, kind = _labelled("source", source) if source else F.lit(None).cast("string"), _labelled("detail-type", detail_type) if detail_type else F.lit(None).cast("string")
    component, trace = _labelled("component", e + "component"), _labelled("trace", e + "trace.trace_id")
    actor, request = _pair("actor", e + "actor.user_id", e + "actor.email"), _pair("req", e + "request.method", e + "request.path")
    error = _pair("error", e + "error.type", e + "error.message")
    stack = none_if_blank(strip(e + "error.stack"))
    props = none_if_blank(blank(e + "props"))
    head = lambda sev: F.concat(F.lit("["), sev, F.lit("] "), F.col("event.name"))
    notifier = F.concat_ws("\n", head(F.upper("event.severity")), "event.message", when, src, kind, component, trace, actor, request, error)
    reporter = F.concat_ws(
        "\n", head(F.lit("ERROR")), "event.message", when, component, src, kind, trace, request, actor, error,
        F.concat(F.lit("stack:\n"), _clip(stack, stack_chars)), F.concat(F.lit("props:\n"), _clip(props, props_chars)),
    )
    unread = F.concat(
        F.lit("[WARN] Unparseable event detail\nsource: "), blank(source) if source else F.lit(""), F.lit("\ndetail-type: "),
        blank(detail_type) if detail_type else F.lit(""), F.lit("\nraw: "), F.col(raw),
    )
    text = F.when(F.col("invalid").isNotNull(), unread).when(F.col("route") == "reporter", reporter).otherwise(notifier)
    return routed.withColumn("text", text)


# The component names below are fixed values the event consumers filter on.
def _event(name: Column, severity: Column, message: Column, component: str, props: Column, key: Column) -> list[Column]:
    body = F.struct(
        F.sha2(F.concat_ws("/", name, key), 256).alias("id"), name.alias("name"), severity.alias("severity"), message.alias("message"),
        F.lit(component).alias("component"), props.alias("props"),
    )
    return [name.alias("name"), severity.alias("severity"), key.alias("key"), F.to_json(body).alias("detail")]


def scrape_events(summary: DataFrame, samples: DataFrame | None = None, most_titles: int | None = None) -> DataFrame:
    """New-notice and failure events per source (fonte, total, new_notices, new_pdfs, error), and the run's event."""
    s = summary
    if samples is not None:
        from pyspark.sql import Window as W

        first = samples if most_titles is None else samples.withColumn("rn", F.row_number().over(W.partitionBy("fonte").orderBy("titulo"))).where(F.col("rn") <= most_titles)
        s = s.join(first.groupBy("fonte").agg(F.sort_array(F.collect_list("titulo")).alias("new_editais")), "fonte", "left")
    else:
        s = s.withColumn("new_editais", F.lit(None).cast("array<string>"))
    found = s.where("error IS NULL AND new_notices > 0").select(
        *_event(
            F.lit("NewEditaisFound"), F.lit("info"),
            F.concat("fonte", F.lit(": "), "new_notices", F.lit(" novo(s) edital(is) ("), "new_pdfs", F.lit(" PDF(s) novos)")),
            "scraper.runner", F.struct("fonte", "new_editais", "new_pdfs", F.col("total").alias("total_seen")), F.col("fonte"),
        )
    )
    failed = s.where("error IS NOT NULL").select(
        *_event(F.lit("JobFailed"), F.lit("error"), F.concat(F.lit("Scraper failed ("), "fonte", F.lit("): "), "error"), "scraper.runner", F.struct("fonte"), F.col("fonte"))
    )
    t = s.agg(
        F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.coalesce(F.sum("new_notices"), F.lit(0)).alias("new_editais"), F.coalesce(F.sum("new_pdfs"), F.lit(0)).alias("new_pdfs"),
    )
    run = t.select(
        *_event(
            F.lit("ScraperRunCompleted"), F.when(F.col("failed") > 0, "warn").otherwise("info"),
            F.concat(F.lit("Scraper run finished: "), "ok", F.lit(" ok, "), "failed", F.lit(" failed, "), "new_editais", F.lit(" new editais, "), "new_pdfs", F.lit(" new pdfs")),
            "scraper.runner", F.struct(F.struct("ok", "failed", "new_editais", "new_pdfs").alias("summary")), F.lit("run"),
        )
    )
    return found.unionByName(failed).unionByName(run)


def processing_event(summary: DataFrame) -> DataFrame:
    """Completion event of a chunk-index run."""
    return summary.select(
        *_event(
            F.lit("DocumentProcessingCompleted"), F.col("severity"),
            F.concat(F.lit("Document processing finished: "), "total_chunks", F.lit(" chunks, "), "embeddings_ok", F.lit(" embeddings, "), "pdf_failures", F.lit(" failures")),
            "document.processor", F.struct("total_chunks", "embeddings_ok", "pdf_failures"), F.lit("run"),
        )
    )


def extraction_events(outcomes: DataFrame) -> DataFrame:
    """Event per processed notice (id, numero, titulo, fonte, status, campos)."""
    saved = F.col("status").isin("ok", "ok_partial", "stamp_only")
    label = F.concat(F.coalesce("numero", F.lit("—")), F.lit(" — "), "titulo")
    headline = F.when(F.col("status") == "ok_partial", "Gravação parcial").when(F.col("status") == "stamp_only", "Data de processamento atualizada").otherwise("Edital salvo")
    name = (
        F.when(F.col("status") == "ok_partial", "ProcessEditalPartialSaved").when(F.col("status") == "stamp_only", "ProcessEditalStamped")
        .when(F.col("status") == "fail", "ProcessEditalFailed").otherwise("ProcessEditalSaved")
    )
    fields = F.when(F.size("campos") > 0, F.concat(F.lit(" • Campos: "), F.array_join("campos", ", "))).otherwise("")
    message = F.when(saved, F.concat(headline, F.lit(": "), label, fields)).otherwise(F.concat(F.lit("Falha ao processar edital ("), label, F.lit(")")))
    severity = F.when(F.col("status") == "fail", "error").when(F.col("status") == "ok_partial", "warn").otherwise("info")
    rows = outcomes.where(saved | (F.col("status") == "fail"))
    props = F.struct(F.col("id").alias("edital_id"), "numero", "titulo", "fonte", "campos")
    return rows.select(*_event(name, severity, message, "process-edital-service", props, F.col("id").cast("string")))


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def run_incremental(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Process what arrived since the last run and stop.

    Each micro-batch writes its own ``batch=N`` folder and overwrites it when replayed, so a batch that is
    retried after a lost executor or driver leaves its result once.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_upserts(stream: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], root: str, checkpoint: str) -> DataFrame:
    """Merge what arrived since the last run into a keyed table, exactly once; returns the table as it stands.

    Each micro-batch turns the version before it into its own: ``merge(None or last version, batch)``. A batch that is replayed starts from the
    same version again and overwrites its own, so nothing is merged twice; readers follow the highest version written.
    """
    spark, root = stream.sparkSession, root.rstrip("/")

    def written(below: int | None = None) -> DataFrame | None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
        # a version without this mark was not finished
        done = [int(n.partition("=")[2]) for n in names if n.startswith("version=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
        done = [n for n in done if below is None or n < below]
        return spark.read.parquet(f"{root}/version={max(done)}") if done else None

    def one(batch: DataFrame, batch_id: int) -> None:
        merge(written(batch_id), batch).write.mode("overwrite").parquet(f"{root}/version={batch_id}")

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return written()
