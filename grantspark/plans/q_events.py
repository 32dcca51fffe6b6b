"""Queries of the domain event group (2.13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import fields as S
from ..operators.chunks import build_queue, index_health, summarize_processing
from ..session import shared_dir
from ..streaming import events as E
from .q_chunks import _HEALTH, _QUEUE
from .q_fields import _STATE, _WORK
from .registry import query

_SEV = "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'info' WHEN 'signup' THEN 'warn' WHEN 'view' THEN 'fatal' ELSE 'debug' END"
_PE = f"""pe AS (SELECT *, {_SEV} AS severity, CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 41 = 0 THEN 'missing id' WHEN event_id % 37 = 0 THEN 'missing name' WHEN event_type = 'click' THEN 'invalid severity' WHEN event_id % 43 = 0 THEN 'missing at' END AS invalid FROM domain_events)"""
_RT = f"{_PE}, rt AS (SELECT *, 'notifier' AS route FROM pe UNION ALL SELECT *, 'reporter' FROM pe WHERE invalid IS NULL AND severity IN ('error','fatal'))"


@query("parse_events", "domain_events", f"WITH {_PE} SELECT event_id, invalid, CASE WHEN invalid IS NULL THEN severity END AS severity FROM pe")
def parse_events(f):
    return E.parse_events(f.domain_events).select("event_id", "invalid", F.when(F.col("invalid").isNull(), F.col("event.severity")).alias("severity"))


@query("route_events", "domain_events", f"WITH {_RT} SELECT event_id, route FROM rt")
def route_events(f):
    return E.route_events(E.parse_events(f.domain_events)).select("event_id", "route")


_L = "chr(10)"
_AT = "'at: '||CASE WHEN event_id % 10 >= 3 THEN '03/02 0'||CAST(event_id % 10 - 3 AS VARCHAR) ELSE '02/02 '||CAST(event_id % 10 + 21 AS VARCHAR) END||':15:07'"
_COMP, _TRACE = "CASE WHEN event_id % 2 = 0 THEN 'component: comp.a' END", "CASE WHEN event_id % 3 = 0 THEN 'trace: t'||CAST(event_id AS VARCHAR) END"
_ACTOR, _REQ = "CASE WHEN event_id % 5 = 0 THEN 'actor: u'||CAST(user_id AS VARCHAR)||' ' END", "CASE WHEN event_id % 5 = 0 THEN 'req: GET /x' END"
_ERR = "CASE WHEN event_id % 7 = 0 THEN 'error: E falhou' END"
_STACK = "CASE WHEN event_id % 7 = 0 THEN 'stack:'||chr(10)||repeat('s', CAST(1490 + event_id % 20 AS BIGINT)) END"


@query("format_messages", "domain_events", f"""WITH {_RT} SELECT event_id, route, CASE WHEN invalid IS NOT NULL THEN '[WARN] Unparseable event detail'||{_L}||'source: '||{_L}||'detail-type: '||{_L}||'raw: '||detail
 WHEN route = 'reporter' THEN concat_ws({_L}, '[ERROR] Job_'||event_type, 'valor '||CAST(user_id AS VARCHAR), {_AT}, {_COMP}, {_TRACE}, {_REQ}, {_ACTOR}, {_ERR}, {_STACK})
 ELSE concat_ws({_L}, '['||upper(severity)||'] Job_'||event_type, 'valor '||CAST(user_id AS VARCHAR), {_AT}, {_COMP}, {_TRACE}, {_ACTOR}, {_REQ}, {_ERR}) END AS text FROM rt""")
def format_messages(f):
    return E.format_messages(E.route_events(E.parse_events(f.domain_events))).select("event_id", "route", "text")


@query("emit_run_events", "notices attachments chunks", "WITH " + _STATE + ", w AS (SELECT *, " + ", ".join(f"{v} AS w_{k}" for k, v in _WORK.items()) + """ FROM st),
o AS (SELECT id, numero, titulo, CASE WHEN needed = '' AND NOT w_stamped THEN 'stamp_only' WHEN needed = '' AND w_deadline_fixed THEN 'ok' WHEN needed = '' THEN 'skip_complete' WHEN NOT w_has_text THEN 'skip_no_documents' WHEN w_error AND w_patched AND w_saved THEN 'ok_partial' WHEN w_error THEN 'fail' WHEN w_patched OR w_deadline_fixed THEN 'ok' ELSE 'skip_no_update' END AS status FROM w),
s AS (SELECT fonte, count(*) AS total, count(*) FILTER (WHERE id % 3 = 0) AS nn, count(*) FILTER (WHERE id % 4 = 0) AS np, CASE WHEN fonte = 'src3' THEN 'timeout' END AS err FROM notices GROUP BY 1)
SELECT 'NewEditaisFound' AS name, 'info' AS severity, fonte AS key, fonte||': '||CAST(nn AS VARCHAR)||' novo(s) edital(is) ('||CAST(np AS VARCHAR)||' PDF(s) novos)' AS message FROM s WHERE err IS NULL AND nn > 0 UNION ALL SELECT 'JobFailed', 'error', fonte, 'Scraper failed ('||fonte||'): timeout' FROM s WHERE err IS NOT NULL
UNION ALL SELECT 'ScraperRunCompleted', CASE WHEN count(err) > 0 THEN 'warn' ELSE 'info' END, 'run', 'Scraper run finished: '||CAST(count(*) - count(err) AS VARCHAR)||' ok, '||CAST(count(err) AS VARCHAR)||' failed, '||CAST(CAST(sum(nn) AS BIGINT) AS VARCHAR)||' new editais, '||CAST(CAST(sum(np) AS BIGINT) AS VARCHAR)||' new pdfs' FROM s
UNION ALL SELECT CASE status WHEN 'ok_partial' THEN 'ProcessEditalPartialSaved' WHEN 'stamp_only' THEN 'ProcessEditalStamped' WHEN 'fail' THEN 'ProcessEditalFailed' ELSE 'ProcessEditalSaved' END, CASE status WHEN 'fail' THEN 'error' WHEN 'ok_partial' THEN 'warn' ELSE 'info' END, CAST(id AS VARCHAR),
 CASE status WHEN 'fail' THEN 'Falha ao processar edital ('||coalesce(numero,'—')||' — '||titulo||')' WHEN 'ok_partial' THEN 'Gravação parcial: '||coalesce(numero,'—')||' — '||titulo||' • Campos: vagas' WHEN 'stamp_only' THEN 'Data de processamento atualizada: '||coalesce(numero,'—')||' — '||titulo||' • Campos: vagas' ELSE 'Edital salvo: '||coalesce(numero,'—')||' — '||titulo||' • Campos: vagas' END FROM o WHERE status IN ('ok','ok_partial','stamp_only','fail')""")
def emit_run_events(f):
    n = f.notices
    flags = n.select("id", *[F.expr(v).alias(k) for k, v in _WORK.items()])
    outcomes = S.process_outcomes(S.needs_extraction(n).join(flags, "id")).select("id", "status").join(n.select("id", "numero", "titulo", "fonte"), "id")
    runs = n.groupBy("fonte").agg(F.count("*").alias("total"), F.count_if(F.col("id") % 3 == 0).alias("new_notices"), F.count_if(F.col("id") % 4 == 0).alias("new_pdfs"))
    runs = runs.withColumn("error", F.when(F.col("fonte") == "src3", "timeout"))
    out = E.scrape_events(runs).unionByName(E.extraction_events(outcomes.withColumn("campos", F.array(F.lit("vagas")))))
    return out.select("name", "severity", "key", F.get_json_object("detail", "$.message").alias("message"))


@query("emit_processing_event", "attachments chunks", f"""WITH {_QUEUE}, {_HEALTH}, t AS (SELECT CAST(coalesce(sum(total),0) AS BIGINT) AS c, CAST(coalesce(sum(with_embedding),0) AS BIGINT) AS e, count(*) FILTER (WHERE NOT coalesce(fully_indexed,false)) AS p FROM qu LEFT JOIN hl ON qu.file_key = hl.file_id)
SELECT 'DocumentProcessingCompleted' AS name, CASE WHEN p > 0 THEN 'warn' ELSE 'info' END AS severity, 'Document processing finished: '||CAST(c AS VARCHAR)||' chunks, '||CAST(e AS VARCHAR)||' embeddings, '||CAST(p AS VARCHAR)||' failures' AS message FROM t""")
def emit_processing_event(f):
    out = E.processing_event(summarize_processing(index_health(f.chunks), build_queue(f.attachments)))
    return out.select("name", "severity", F.get_json_object("detail", "$.message").alias("message"))


def _last_events(before, batch):
    """Events per user, and the latest one: counts add up, so every event must be merged once."""
    new = batch.groupBy("user_id").agg(F.count("*").alias("events"), F.max(F.struct("event_id", "event_type")).alias("last"))
    both = new if before is None else before.unionByName(new)
    return both.groupBy("user_id").agg(F.sum("events").alias("events"), F.max("last").alias("last"))


@query("incremental_pending", "", "SELECT user_id, count(*) AS events, max(event_id) AS last_event, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1")
def incremental_pending(f):
    """Events of all types land in two parts with a run after each, and one more that finds nothing new; the table holds each once."""
    run = f"{shared_dir(f.spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    for part in (0, 1):
        f.events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).write.mode("append").parquet(f"{run}/landed")
        stream = E.read_stream(f.spark, f"{run}/landed", f.events.schema)
        E.run_upserts(stream, _last_events, f"{run}/out", f"{run}/checkpoint")
    found = E.run_upserts(stream, _last_events, f"{run}/out", f"{run}/checkpoint")
    return found.select("user_id", "events", F.col("last.event_id").alias("last_event"), F.col("last.event_type").alias("last_type"))
