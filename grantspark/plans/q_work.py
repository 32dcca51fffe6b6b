"""Queries of the work selection, catalogue and audit groups (2.9, 2.10, 2.12)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FIELDS
from ..operators import audits as A
from ..operators import catalogue as C
from ..operators import work as Q
from ..operators.chunks import index_health
from ..operators.fields import needs_extraction
from . import duck as d
from .derived import AS_OF
from .q_chunks import _HEALTH
from .q_deadlines import _PATS
from .q_fields import _STATE, ECHOES
from .q_retrieval import _PAIRS, _pairs_only
from .registry import query

STAMP = datetime(AS_OF.year, AS_OF.month, AS_OF.day)
_COUNTS = f"{_PAIRS}, cc AS (SELECT CAST(notice_id AS BIGINT) AS id, count(*) AS chunks FROM pr GROUP BY 1)"


def _counts(f):
    return _pairs_only(f).groupBy(F.col("notice_id").cast("long").alias("id")).agg(F.count("*").alias("chunks"))


@query("filter_backlog", "notices catalogue attachments chunks", f"""WITH {_COUNTS}, {_STATE}
SELECT id FROM st WHERE id NOT IN (SELECT id FROM catalogue) AND id IN (SELECT edital_id FROM attachments) AND id IN (SELECT id FROM cc) AND needed <> ''""")
def filter_backlog(f):
    n = f.notices
    att = f.attachments.select(F.col("edital_id").alias("id"))
    return Q.filter_backlog(n, f.catalogue, att, _counts(f), needs_extraction(n)).select("id")


@query("order_work", "notices chunks attachments", f"WITH {_COUNTS}, {_STATE} SELECT st.id, chunks, needed <> '' AS needs_any, informacoes_processadas_em IS NOT NULL AS processed FROM st LEFT JOIN cc ON cc.id = st.id")
def order_work(f):
    out = Q.order_work(f.notices, "pending_first", _counts(f), needs_extraction(f.notices))
    return out.select("id", "chunks", "needs_any", "processed")


_NEWEST = "n.criado_em DESC NULLS LAST, n.id"
_BY_CHUNKS = "chunks DESC NULLS LAST, CASE WHEN chunks IS NOT NULL THEN n.id END NULLS LAST"
_SQL_ORDERS = {
    "new_first": f"n.informacoes_processadas_em IS NOT NULL, {_NEWEST}",
    "pending_first": f"{_BY_CHUNKS}, n.needed <> '' DESC, {_NEWEST}",
    "documents_chunks_only": f"{_BY_CHUNKS}, {_NEWEST}",
    "fetch": _NEWEST,
}


@query("order_work_positions", "notices chunks attachments", f"WITH {_COUNTS}, {_STATE} " + " UNION ALL ".join(
    f"SELECT '{mode}' AS mode, n.id, row_number() OVER (ORDER BY {keys}) AS pos FROM st n LEFT JOIN cc ON cc.id = n.id" for mode, keys in _SQL_ORDERS.items()))
def order_work_positions(f):
    """Place of every notice in each of the four working orders."""
    counts, needs = f.stored("counts", lambda: _counts(f)), f.stored("needs", lambda: needs_extraction(f.notices).select("id", "needs_any"))
    notices = f.stored("work", lambda: f.notices.select("id", "criado_em", "informacoes_processadas_em"))
    out = [Q.numbered(Q.order_work(notices, mode, counts, needs)).select(F.lit(mode).alias("mode"), "id", F.col("pos").cast("long").alias("pos")) for mode in Q.ORDERS]
    return reduce(DataFrame.unionByName, out)


@query("take_batch", "notices", """SELECT 'new_first' AS mode, id FROM (SELECT id FROM notices ORDER BY informacoes_processadas_em IS NOT NULL, criado_em DESC, id LIMIT 50) a UNION ALL SELECT 'fetch', id FROM (SELECT id FROM notices ORDER BY criado_em DESC, id LIMIT 50) b""")
def take_batch(f):
    pick = lambda mode: Q.take_batch(Q.order_work(f.notices, mode), 50).select(F.lit(mode).alias("mode"), "id")
    return pick("new_first").unionByName(pick("fetch"))


_MEAN = {
    "valor_projeto": "coalesce(lower(trim(valor_projeto)),'') NOT IN ('','não informado')", "is_researcher": "is_researcher IS NOT NULL", "is_company": "is_company IS NOT NULL",
    "timeline_estimada": "id % 4 IN (2, 3)",
    **{c: f"coalesce(lower(trim({c})),'') NOT IN ('','não informado')" for c in ("prazo_inscricao", "localizacao", "vagas", "sobre_programa", "criterios_elegibilidade")},
}
_EXTRACTED = "concat_ws(',', " + ", ".join(f"CASE WHEN {_MEAN[c]} THEN '{c}' END" for c in FIELDS) + ")"


@query("validation_candidates", "notices catalogue", f"SELECT id, {_EXTRACTED} AS extracted FROM notices WHERE informacoes_processadas_em IS NOT NULL AND id NOT IN (SELECT id FROM catalogue) AND {_EXTRACTED} <> ''")
def validation_candidates(f):
    return Q.validation_candidates(f.notices, f.catalogue).select("id", F.array_join("extracted", ",").alias("extracted"))


_CELLS = " UNION ALL ".join(
    f"SELECT id, numero, fonte, '{c}' AS field, CAST({c} AS VARCHAR) AS raw, {_MEAN[c]} AS meaningful, {str(c in C.ALWAYS_AUDITED).lower()} AS always FROM notices" for c in FIELDS
)
_TARGETS = f"cl AS ({_CELLS}), tg AS (SELECT id, numero, fonte, field, CASE WHEN meaningful THEN raw END AS before, CASE WHEN always OR meaningful THEN 'audit' ELSE 'skip_empty' END AS action FROM cl)"


@query("audit_targets", "notices responses", f"WITH {_TARGETS}, ev AS (SELECT DISTINCT notice_id, field FROM responses WHERE stage = 'topk') SELECT tg.id, tg.field, before, action, ev.field IS NOT NULL AS evidence_first FROM tg LEFT JOIN ev ON ev.notice_id = tg.id AND ev.field = tg.field")
def audit_targets(f):
    ev = f.responses.where("stage = 'topk'").select(F.col("notice_id").alias("id"), "field", F.lit("trecho").alias("snippet"))
    return C.audit_targets(f.notices, ev).select("id", "field", "before", "action", "evidence_first")


def _raw_audits(f):
    k = F.col("event_id").cast("string")
    value = F.when(F.col("fk") == 0, F.concat(F.lit('" Até '), k, F.lit(' "'))).when(F.col("fk") == 1, "true").when(F.col("fk") == 2, '"Não informado"').otherwise('{"fases":[{"nome":"A","prazo":"x"}]}')
    key = F.concat(F.lit('"'), "field", F.lit('":'))
    said = lambda s: F.lit(f'"_audit":{{"decision":"{s}","reason":"r"}}')
    form = F.col("form")
    raw = (
        F.when(form == 0, F.concat(F.lit("{"), key, value, F.lit(","), said("accept"), F.lit("}")))
        .when(form == 1, F.concat(F.lit("```json\n{"), key, value, F.lit(","), said("Replace"), F.lit("}\n```")))
        .when(form == 2, F.concat(F.lit("{"), said("reject"), F.lit("}")))
        .when(form == 3, F.concat(F.lit("{"), said("accept"), F.lit("}")))
        .when(form == 4, "sem json")
        .when(form == 5, F.concat(F.lit("{"), key, F.lit("12,"), said("accept"), F.lit("}")))
        .when(form == 6, F.concat(F.lit("{"), key, F.lit("null,"), said("accept"), F.lit("}")))
        .when(form == 7, F.concat(F.lit("{"), key, value, F.lit("}")))
        .otherwise(F.concat(F.lit("{"), key, value, F.lit(","), said("reject"), F.lit("}")))
    )
    return f.audits.select("event_id", "notice_id", "field", F.col("event_id").alias("batch"), raw.alias("raw"), "timed_out")


_AUD = """au AS (SELECT *, form NOT IN (3, 4, 5) AS ok, CASE WHEN form IN (0, 1, 7) THEN CASE fk WHEN 0 THEN 'Até '||CAST(event_id AS VARCHAR) WHEN 1 THEN 'true' WHEN 3 THEN '{"fases":[{"nome":"A","prazo":"x","status":null,"data_inicio":null,"data_fim":null}]}' END END AS value,
 CASE form WHEN 0 THEN 'accept' WHEN 1 THEN 'replace' WHEN 2 THEN 'reject' WHEN 3 THEN 'accept' WHEN 4 THEN 'unknown' WHEN 5 THEN 'accept' WHEN 6 THEN 'accept' WHEN 7 THEN 'accept' ELSE 'reject' END AS decision, CASE form WHEN 4 THEN 'missing_field_in_json' WHEN 7 THEN '' ELSE 'r' END AS reason FROM audits)"""


@query("parse_audits", "audits", f"WITH {_AUD} SELECT event_id, ok, value, decision, reason FROM au")
def parse_audits(f):
    return C.parse_audits(_raw_audits(f)).select("event_id", "ok", "value", "decision", "reason")


_RES = f"""{_AUD}, ra AS (SELECT notice_id, field, coalesce(min(event_id) FILTER (WHERE ok AND decision IN ('accept','replace')), max(event_id) FILTER (WHERE ok AND decision = 'reject'), max(event_id)) AS event_id FROM au WHERE NOT timed_out GROUP BY 1, 2),
rv AS (SELECT au.notice_id, au.field, ok, value, decision FROM ra JOIN au ON au.event_id = ra.event_id)"""


@query("resolve_audits", "audits", f"WITH {_RES} SELECT * FROM rv")
def resolve_audits(f):
    return C.resolve_audits(C.parse_audits(_raw_audits(f))).select("notice_id", "field", "ok", "value", "decision")


@query("field_status", "notices audits", f"""WITH {_RES}, {_TARGETS}, j AS (SELECT tg.*, coalesce(action = 'audit' AND rv.ok, false) AS audited, rv.value AS v FROM tg LEFT JOIN rv ON rv.notice_id = tg.id AND rv.field = tg.field),
k AS (SELECT id, field, before, CASE WHEN action <> 'audit' THEN 'skipped' WHEN NOT audited THEN 'inconclusive' WHEN v IS NULL AND before IS NOT NULL THEN 'cleared' WHEN v IS DISTINCT FROM before THEN 'corrected' ELSE 'kept' END AS status, CASE WHEN audited THEN v ELSE before END AS after FROM j)
SELECT id, field, status, after, CASE WHEN status = 'cleared' THEN 'null' WHEN status = 'corrected' AND after IS NOT NULL THEN 'value' END AS update FROM k""")
def field_status(f):
    out = C.field_status(C.audit_targets(f.notices), C.resolve_audits(C.parse_audits(_raw_audits(f))), f.notices)
    return out.select("id", "field", "status", "after", "update")


_M = "CASE WHEN coalesce(lower(trim({0})),'') NOT IN ('','não informado') THEN trim(regexp_replace({0}, '\\s+', ' ', 'g')) END"
_SITE = """CASE id % 4 WHEN 2 THEN '{"fases":[{"nome":"Lançamento","prazo":null,"status":null,"data_inicio":"01/01/'||left(data_publicacao,4)||'","data_fim":null},{"nome":"Submissão de propostas","prazo":"de 02/01/'||left(data_publicacao,4)||' até '||strftime(criado_em, '%d/%m/%Y')||'","status":"aberto","data_inicio":null,"data_fim":null}]}'
 WHEN 3 THEN '{"fases":[{"nome":"Inscrições","prazo":null,"status":null,"data_inicio":null,"data_fim":"'||strftime(criado_em, '%d/%m/%Y')||'"},{"nome":null,"prazo":"x","status":null,"data_inicio":null,"data_fim":null},{"nome":"Resultado","prazo":"31/12/'||left(data_publicacao,4)||'","status":null,"data_inicio":null,"data_fim":null}]}' END"""
_FORMAT = f"""fm AS (SELECT id, criado_em, data_publicacao, data_encerramento, is_researcher, is_company, {', '.join(f"{_M.format(c)} AS {c}" for c in ('numero', 'titulo', 'status', 'area', 'orgao', 'fonte', 'link', 'valor_projeto', 'prazo_inscricao', 'localizacao', 'vagas', 'sobre_programa', 'criterios_elegibilidade'))},
 coalesce({_M.format('descricao')}, replace({_M.format('sobre_programa')}, '**', '')) AS descricao, {_SITE} AS timeline_estimada, timeline_estimada AS tl0 FROM notices)"""
_FCOLS = ("numero", "titulo", "descricao", "status", "area", "orgao", "fonte", "link", "valor_projeto", "prazo_inscricao", "localizacao", "vagas", "is_researcher", "is_company", "sobre_programa", "criterios_elegibilidade", "timeline_estimada")


@query("format_catalogue", "notices", f"WITH {_FORMAT} SELECT id, {', '.join(_FCOLS)} FROM fm")
def format_catalogue(f):
    return C.format_catalogue(f.notices, STAMP).select("id", *_FCOLS)


_STX = "lower(concat_ws(' ', nullif(titulo,''), nullif(descricao,''), nullif(sobre_programa,''), nullif(prazo_inscricao,''), nullif(data_encerramento,''), nullif(timeline_estimada,'')))"
# prazo dates (an ISO text is one token), the closing date if it is a whole date, else text and phases
_LIVE = f"""lv AS (SELECT *, regexp_matches({_STX}, '(^|[^0-9])({_PATS})([^0-9]|$)') AS hit, greatest(CASE WHEN id % 6 IN (2, 4) THEN CAST(criado_em AS DATE) WHEN id % 6 = 3 THEN greatest(CAST(criado_em AS DATE), make_date(CAST(year(criado_em) AS INT), 1, 1)) END, CASE WHEN id % 9 IN (0, 1, 2) THEN NULL ELSE CAST(criado_em AS DATE) END) AS st FROM fm),
lw AS (SELECT *, CASE WHEN lower(status) = 'encerrado' THEN false WHEN st IS NOT NULL THEN st >= DATE '{AS_OF}' ELSE hit OR (id % 4 IN (2, 3) AND criado_em >= DATE '1998-08-01') OR (id % 4 = 3 AND year(criado_em) >= 1998) OR (id % 4 = 2 AND year(criado_em) > 1998) END AS active FROM lv),
pz AS (SELECT *, concat_ws(',', CASE WHEN length(coalesce(titulo,'')) < 5 THEN 'titulo_curto' END, CASE WHEN NOT regexp_matches(coalesce(link,''), '^https?://', 'i') THEN 'link_invalido' END, CASE WHEN length(coalesce(sobre_programa, descricao, '')) < 50 THEN 'resumo_insuficiente' END,
 CASE WHEN NOT is_researcher AND NOT is_company THEN 'publico_alvo_exclui_pesquisador_e_empresa' END, CASE WHEN prazo_inscricao IS NULL AND NOT active THEN 'sem_prazo_inscricao' END, CASE WHEN NOT active THEN 'prazo_encerrado' END) AS why,
 coalesce(valor_projeto, prazo_inscricao, sobre_programa, criterios_elegibilidade, timeline_estimada, localizacao, vagas, CAST(is_researcher AS VARCHAR), CAST(is_company AS VARCHAR)) IS NOT NULL AS useful FROM lw),
pq AS (SELECT *, CASE WHEN useful THEN why ELSE 'sem_campos_uteis' END AS reasons FROM pz)"""


@query("presentability", "notices", f"WITH {_FORMAT}, {_LIVE} SELECT id, reasons, reasons = '' AS presentable FROM pq")
def presentability(f):
    out = C.presentability(C.format_catalogue(f.notices, STAMP), AS_OF)
    return out.select("id", F.array_join("reasons", ",").alias("reasons"), "presentable")


@query("publish_catalogue", "notices catalogue", f"""WITH {_FORMAT}, {_LIVE}, ex AS (SELECT id, {_EXTRACTED} AS extracted FROM notices)
SELECT id, titulo, 'old' AS kind, NULL AS extracted FROM catalogue WHERE id NOT IN (SELECT id FROM pq WHERE reasons = '') UNION ALL SELECT pq.id, titulo, 'new', extracted FROM pq JOIN ex ON ex.id = pq.id WHERE reasons = ''""")
def publish_catalogue(f):
    out = C.publish_catalogue(f.catalogue, f.notices, AS_OF, STAMP)
    names = F.array_join(F.from_json(F.get_json_object("validation_report", "$.extracted_fields"), "array<string>"), ",")
    return out.select("id", "titulo", F.when(F.col("validation_report").isNull(), "old").otherwise("new").alias("kind"), names.alias("extracted"))


@query("funnel_stats", "notices catalogue attachments chunks", """SELECT count(*) AS notices, count(CASE WHEN id % 4 <> 0 THEN 1 END) AS pdf_processed, count(informacoes_processadas_em) AS with_info, count(*) - count(informacoes_processadas_em) AS pending,
 (SELECT count(*) FROM catalogue) AS catalogue, (SELECT count(*) FROM attachments) AS attachments, (SELECT count(*) FROM chunks) AS chunks, greatest(0, count(informacoes_processadas_em) - (SELECT count(*) FROM catalogue)) AS backlog,
 CAST(floor(100.0 * count(CASE WHEN id % 4 <> 0 THEN 1 END) / count(*) + 0.5) AS BIGINT) AS pdf_pct, CAST(floor(100.0 * count(informacoes_processadas_em) / count(*) + 0.5) AS BIGINT) AS info_pct, CAST(floor(100.0 * (SELECT count(*) FROM catalogue) / count(*) + 0.5) AS BIGINT) AS catalogue_pct FROM notices""")
def funnel_stats(f):
    n = f.notices.withColumn("processado_em", F.when(F.col("id") % 4 != 0, F.col("criado_em")))
    return C.funnel_stats(n, f.catalogue, f.attachments, f.chunks)


_EXPECTED = [f"src{i}" for i in range(0, 32)]


@query("source_completeness", "notices", """WITH e AS (SELECT 'src'||CAST(range AS VARCHAR) AS fonte FROM range(0, 32)), p AS (SELECT fonte, count(*) AS total, count(valor_projeto) AS with_value, count(prazo_inscricao) AS with_deadline, count(sobre_programa) AS with_summary, count(criterios_elegibilidade) AS with_criteria,
 count(informacoes_processadas_em) AS processed, count(*) FILTER (WHERE length(valor_projeto) > 500) AS value_overflow, CAST(coalesce(max(length(valor_projeto)), 0) AS BIGINT) AS max_value_chars FROM notices GROUP BY 1)
SELECT coalesce(e.fonte, p.fonte) AS fonte, coalesce(total,0) AS total, coalesce(with_value,0) AS with_value, coalesce(with_deadline,0) AS with_deadline, coalesce(with_summary,0) AS with_summary, coalesce(with_criteria,0) AS with_criteria, coalesce(processed,0) AS processed,
 coalesce(value_overflow,0) AS value_overflow, coalesce(max_value_chars,0) AS max_value_chars, e.fonte IS NOT NULL AS expected FROM e FULL OUTER JOIN p ON e.fonte = p.fonte""")
def source_completeness(f):
    return A.source_completeness(f.notices, _EXPECTED)


@query("attachment_coverage", "notices attachments", """WITH a AS (SELECT edital_id, count(*) AS files, count(*) FILTER (WHERE is_processed) AS done FROM attachments GROUP BY 1)
SELECT fonte, count(*) AS total, count(files) AS with_pdf, count(*) FILTER (WHERE done >= files) AS pdf_done, count(*) - count(files) AS without_pdf, count(*) - count(valor_projeto) AS no_value, count(*) - count(prazo_inscricao) AS no_deadline, count(*) - count(informacoes_processadas_em) AS unprocessed
FROM notices LEFT JOIN a ON a.edital_id = id GROUP BY 1""")
def attachment_coverage(f):
    return A.attachment_coverage(f.notices, f.attachments)


_TITLES = "tt AS (SELECT 'n'||CAST(id AS VARCHAR) AS k, titulo, fonte FROM notices UNION ALL SELECT 'p'||CAST(p_partkey AS VARCHAR), CASE p_partkey % 5 WHEN 0 THEN 'Novo' WHEN 1 THEN p_brand WHEN 2 THEN 'x' WHEN 3 THEN 'RESULTADO' ELSE p_name END, p_brand FROM part)"


@query("suspicious_titles", "notices", f"""WITH {_TITLES} SELECT * FROM (SELECT k, CASE WHEN length(trim(titulo)) < 4 THEN 'vazio/curto' WHEN length(titulo) <= 12 AND {d.has('titulo', A.BADGE)} THEN 'badge/rótulo' WHEN {d.has('titulo', A.BAD_TITLE)} THEN 'padrão inválido' WHEN {d.supp('titulo')} THEN 'adendo/suplemento'
 WHEN upper(titulo) = upper(fonte) THEN 'igual à fonte' WHEN NOT regexp_matches(titulo, '[0-9]') AND length(titulo) < 25 AND NOT {d.has('titulo', A.TITLE_WORD)} THEN 'sem número nem palavra-chave' END AS reason FROM tt) z WHERE reason IS NOT NULL""")
def suspicious_titles(f):
    k = F.col("p_partkey")
    t = F.when(k % 5 == 0, "Novo").when(k % 5 == 1, F.col("p_brand")).when(k % 5 == 2, "x").when(k % 5 == 3, "RESULTADO").otherwise(F.col("p_name"))
    rows = f.notices.select(F.concat(F.lit("n"), "id").alias("k"), "titulo", "fonte").unionByName(f.part.select(F.concat(F.lit("p"), k).alias("k"), t.alias("titulo"), F.col("p_brand").alias("fonte")))
    return A.suspicious_titles(rows).select("k", "reason")


@query("repair_titles", "notices", f"""WITH r AS (SELECT id, titulo, CASE WHEN trim(coalesce(numero,'')) <> '' AND ({d.supp('titulo')} OR {d.weak('titulo')} OR length({d.link_text('titulo')}) < 12) THEN {d.title('titulo', 'numero', 'fonte')} END AS proposed FROM notices)
SELECT id, titulo, proposed FROM r WHERE proposed IS NOT NULL AND proposed <> titulo""")
def repair_titles(f):
    return A.repair_titles(f.notices.select("id", "titulo", "numero", "fonte")).drop("numero", "fonte")


_CORRUPT = f"""{_HEALTH}, kk AS (SELECT *, trim(coalesce(nullif(file_id,''), CAST(id AS VARCHAR))) AS file_key FROM attachments), nw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY id DESC) AS rn FROM kk) t WHERE rn = 1),
cr AS (SELECT file_key, id, edital_id, coalesce(total, 0) AS total FROM nw LEFT JOIN hl ON hl.file_id = nw.file_key WHERE is_processed AND NOT coalesce(fully_indexed, false))"""


@query("corrupt_index", "attachments chunks", f"WITH {_CORRUPT} SELECT * FROM cr")
def corrupt_index(f):
    return A.corrupt_index(f.attachments, index_health(f.chunks))


@query("corrupt_index_repair", "attachments chunks notices", f"""WITH {_CORRUPT} SELECT 'flags' AS part, count(*) AS n FROM kk WHERE is_processed AND file_key NOT IN (SELECT file_key FROM cr) UNION ALL SELECT 'chunks', count(*) FROM chunks WHERE file_id NOT IN (SELECT file_key FROM cr)
UNION ALL SELECT 'stamps', count(*) FROM notices WHERE informacoes_processadas_em IS NOT NULL AND id NOT IN (SELECT edital_id FROM cr)""")
def corrupt_index_repair(f):
    a, c, n = A.repair_corrupt_index(A.corrupt_index(f.attachments, index_health(f.chunks)), f.attachments, f.chunks, f.notices)
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    return count("flags", a.where("is_processed")).unionByName(count("chunks", c)).unionByName(count("stamps", n.where("informacoes_processadas_em IS NOT NULL")))




@query("false_stamps", "notices catalogue chunks attachments", f"""WITH {_COUNTS} SELECT id FROM notices WHERE informacoes_processadas_em IS NOT NULL AND id NOT IN (SELECT id FROM catalogue) AND id % 6 < 2 AND id IN (SELECT id FROM cc)""")
def false_stamps(f):
    hollow = f.notices.withColumns({c: F.when(F.col("id") % 6 >= 2, F.col(c)) for c in FIELDS if c != "prazo_inscricao"})
    return A.false_stamps(hollow, f.catalogue, _counts(f)).select("id")


@query("clean_echoes", "notices", f"""WITH ec AS ({ECHOES}), x AS (SELECT id, 'vagas' AS field, CASE WHEN id % 8 = 4 AND numero IS NULL THEN 'N/A 1 — '||replace(split_part(text, ' — ', 2), '. Campo: Critérios de Elegibilidade. ', '. ') ELSE body END AS after FROM ec WHERE id % 8 <> 7
 UNION ALL SELECT id, 'valor_projeto', '{{"valor":["'||body||'","x"]}}' FROM ec WHERE id % 8 IN (0, 2) UNION ALL SELECT id, 'localizacao', NULL FROM ec WHERE id % 8 = 2)
SELECT id, field, after, true AS changed, after IS NULL AS nulled FROM x""")
def clean_echoes(f):
    e = f.spark.sql(ECHOES.replace("FROM notices", "FROM {notices}"), notices=f.notices)
    texts = e.select(
        "id", "numero", "fonte", F.col("text").alias("vagas"),
        F.when(F.col("id") % 8 == 2, "Campo: vagas Texto: ").alias("localizacao"),
        F.when((F.col("id") % 8).isin(0, 2), F.concat(F.lit('{"valor":["'), "text", F.lit('","x","Campo: vagas"]}'))).otherwise('{"valor":["y"]}').alias("valor_projeto"),
    )
    return A.clean_echoes(texts, fields=("vagas", "localizacao", "valor_projeto")).where("changed").select("id", "field", "after", "changed", "nulled")


@query("recent_sample", "notices attachments", """SELECT n.id, fonte, left(titulo, 55) AS titulo, valor_projeto IS NOT NULL AS has_value, prazo_inscricao IS NOT NULL AS has_deadline, (SELECT count(*) FROM attachments a WHERE a.edital_id = n.id) AS pdfs, informacoes_processadas_em IS NOT NULL AS processed
FROM (SELECT * FROM notices ORDER BY criado_em DESC, id LIMIT 8) n""")
def recent_sample(f):
    return A.recent_sample(f.notices, f.attachments)
