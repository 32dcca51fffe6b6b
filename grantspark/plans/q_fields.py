"""Queries of the field state group (2.6)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..config import FIELDS
from ..operators import fields as S
from . import duck as d
from .derived import AS_OF
from .registry import query

STAMP = datetime(AS_OF.year, AS_OF.month, AS_OF.day)
# value of an answer by its shape: 0 and 1 carry the value, 6 a text saying nothing was found
_PARSED = """pa AS (SELECT *, event_id % 7 IN (0, 1, 4, 5, 6) AS has_key, CASE WHEN event_id % 7 IN (0, 1) THEN CASE field WHEN 'timeline_estimada' THEN '{"fases":[{"nome":"Inscrição","prazo":"até 10/05/1998","status":null,"data_inicio":null,"data_fim":null}]}'
 WHEN 'valor_projeto' THEN '{"por_projeto":["até R$ 5.000,00"]}' WHEN 'is_researcher' THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 'is_company' THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END ELSE 'texto '||CAST(event_id AS VARCHAR) END
 WHEN event_id % 7 = 6 AND field NOT IN ('is_researcher', 'is_company', 'timeline_estimada') THEN 'Não informado' END AS value FROM responses)"""


@query("parse_responses", "responses", f"WITH {_PARSED} SELECT event_id, has_key, NOT has_key AS retry, value FROM pa")
def parse_responses(f):
    return S.parse_responses(f.responses, f.notices).select("event_id", "has_key", "retry", "value")


_FIRST = f"""{_PARSED}, ok AS (SELECT *, value IS NOT NULL AND value <> 'Não informado' AND NOT timed_out AS good FROM pa),
fu AS (SELECT notice_id, field, stage, arg_min(value, batch) FILTER (WHERE good) AS value, CAST(min(batch) FILTER (WHERE good) AS BIGINT) AS batch, bool_or(timed_out) AS timed_out, count(*) AS answers FROM ok GROUP BY 1, 2, 3)"""


def _first(f):
    # several answers of one batch would tie; the event id makes the order total
    p = S.parse_responses(f.responses, f.notices).withColumn("batch", F.col("batch").cast("long") * 1000000000 + F.col("event_id"))
    return S.first_useful(p)


_FIRST_ID = _FIRST.replace("arg_min(value, batch)", "arg_min(value, CAST(batch AS BIGINT) * 1000000000 + event_id)").replace("min(batch)", "min(CAST(batch AS BIGINT) * 1000000000 + event_id)")


@query("first_useful", "responses", f"WITH {_FIRST_ID} SELECT * FROM fu")
def first_useful(f):
    return _first(f)


_ORDER = "CASE stage WHEN 'topk' THEN 0 WHEN 'chunkscan' THEN 1 ELSE 2 END"


@query("source_cascade", "responses", f"""WITH {_FIRST_ID}, b AS (SELECT notice_id, field, arg_min(stage, {_ORDER}) FILTER (WHERE value IS NOT NULL) AS stage, arg_min(value, {_ORDER}) FILTER (WHERE value IS NOT NULL) AS value, max({_ORDER}) AS last FROM fu GROUP BY 1, 2)
SELECT notice_id, field, stage, value, CASE WHEN stage IS NULL THEN CASE last WHEN 0 THEN 'chunkscan' WHEN 1 THEN 'window' END END AS next_stage FROM b""")
def source_cascade(f):
    resolved, still_open = S.source_cascade(_first(f))
    return resolved.drop("batch").withColumn("next_stage", F.lit(None).cast("string")).unionByName(still_open, allowMissingColumns=True)


_MISS = "lower(trim(regexp_replace(coalesce({0},''), '\\s+', ' ', 'g'))) IN ('','null','undefined','não informado','nao informado','não informado pelo edital','nao informado pelo edital')"
_TEXTS = ("prazo_inscricao", "localizacao", "vagas", "sobre_programa", "criterios_elegibilidade")


@query("nullish_flags", "notices", "WITH u AS (" + " UNION ALL ".join(f"SELECT id, '{c}' AS field, {c} AS v FROM notices" for c in _TEXTS) + f") SELECT id, field, {_MISS.format('v')} AS missing, {_MISS.format('v')} OR length(trim(v)) < 50 AS too_short FROM u")
def nullish_flags(f):
    return S.nullish_flags(f.notices)


# timelines of forms 2 and 3 carry dates; value forms 0 and 1 are empty or the notice's own kind of number
_NEED = {
    "valor_projeto": "id % 5 IN (0, 1)", "timeline_estimada": "id % 4 IN (0, 1)", "is_researcher": "is_researcher IS NULL", "is_company": "is_company IS NULL",
    **{c: f"{_MISS.format(c)} OR length(trim({c})) < 50" for c in _TEXTS},
}
_USE = {
    "valor_projeto": "id % 5 NOT IN (0, 1)", "timeline_estimada": "id % 4 IN (2, 3)", "is_researcher": "is_researcher IS NOT NULL", "is_company": "is_company IS NOT NULL",
    **{c: f"NOT {_MISS.format(c)}" for c in _TEXTS},
}
_STATE = "st AS (SELECT *, concat_ws(',', " + ", ".join(f"CASE WHEN {_NEED[c]} THEN '{c}' END" for c in FIELDS) + ") AS needed, concat_ws(',', " + ", ".join(f"CASE WHEN {_USE[c]} THEN '{c}' END" for c in FIELDS) + ") AS useful_fields FROM notices)"


@query("needs_extraction", "notices", f"WITH {_STATE} SELECT id, needed, needed <> '' AS needs_any, useful_fields <> '' AS has_useful FROM st")
def needs_extraction(f):
    return S.needs_extraction(f.notices).withColumn("needed", F.array_join("needed", ","))


@query("normalize_timeline", "notices", """SELECT id, CASE id % 4 WHEN 2 THEN '{"fases":[{"nome":"Lançamento","prazo":null,"status":null,"data_inicio":"01/01/'||left(data_publicacao,4)||'","data_fim":null},{"nome":"Submissão de propostas","prazo":"de 02/01/'||left(data_publicacao,4)||' até '||strftime(criado_em, '%d/%m/%Y')||'","status":"aberto","data_inicio":null,"data_fim":null}]}'
 WHEN 3 THEN '{"fases":[{"nome":"Inscrições","prazo":null,"status":null,"data_inicio":null,"data_fim":"'||strftime(criado_em, '%d/%m/%Y')||'"},{"nome":"Resultado","prazo":"31/12/'||left(data_publicacao,4)||'","status":null,"data_inicio":null,"data_fim":null}]}' END AS timeline FROM notices""")
def normalize_timeline(f):
    return S.normalize_timeline(f.notices).select("id", "timeline")


# one echoed header form per order, around a body that must come back alone
ECHOES = """SELECT id, numero, fonte, body, CASE id % 8 WHEN 0 THEN 'Edital: '||coalesce(numero,'N/A')||' — '||titulo||' ('||fonte||') Campo: Localização '||body
 WHEN 1 THEN 'Edital: '||coalesce(numero,'N/A')||' — '||titulo||' ('||fonte||') '||body WHEN 2 THEN '**Campo:** sobre_programa Texto: '||body WHEN 3 THEN body||' Campo: Vagas'
 WHEN 4 THEN coalesce(numero,'N/A 1')||' — '||titulo||'. Campo: Critérios de Elegibilidade. '||body WHEN 5 THEN 'Preserve números, datas, valores monetários e nomes próprios exatamente quando forem factuais no texto original.  '||body
 WHEN 6 THEN 'Texto: '||body ELSE body END AS text FROM (SELECT id, numero, fonte, titulo, 'Bacia do rio '||CAST(id AS STRING)||' prevê apoio' AS body FROM notices) AS b"""


def _echoes(f):
    return f.spark.sql(ECHOES.replace("FROM notices", "FROM {notices}"), notices=f.notices)


@query("strip_prompt_echo", "notices", f"WITH ec AS ({ECHOES}) SELECT id, CASE WHEN id % 8 = 4 AND numero IS NULL THEN 'N/A 1 — '||replace(split_part(text, ' — ', 2), '. Campo: Critérios de Elegibilidade. ', '. ') ELSE body END AS stripped FROM ec")
def strip_prompt_echo(f):
    return S.strip_prompt_echo(_echoes(f)).select("id", "stripped")


@query("evidence_records", "responses", """SELECT notice_id, string_agg(field||'='||source||':'||snippet||':'||ids, ';' ORDER BY field) AS evidence FROM
 (SELECT notice_id, field, CASE WHEN mx >= 0 THEN 'topk' ELSE 'old' END AS source, 'trecho '||CAST(mx AS VARCHAR) AS snippet, CAST(mx % 10 AS VARCHAR)||','||CAST(mx % 3 + 20 AS VARCHAR) AS ids FROM (SELECT notice_id, field, max(event_id) AS mx FROM responses GROUP BY 1, 2) a
  UNION ALL SELECT n.notice_id, 'valor_bolsa', 'old', 'antigo', '1' FROM (SELECT DISTINCT notice_id FROM responses) n) t GROUP BY 1""")
def evidence_records(f):
    e = F.col("event_id")
    found = f.responses.groupBy("notice_id", "field").agg(F.max("event_id").alias("event_id")).select(
        "notice_id", "field", F.lit("topk").alias("stage"), F.concat(F.lit("  trecho "), e).alias("context"),
        F.array((e % 10).cast("string"), (e % 3 + 20).cast("string"), (e % 10).cast("string"), F.lit(" ")).alias("chunk_ids"), F.lit(None).cast("int").alias("chunk_index"),
    )
    old = F.from_json(F.lit('{"valor_bolsa":{"source":"old","snippet":"antigo","document_ids":["1"]},"vagas":{"source":"old","snippet":"x","document_ids":["2"]}}'), f"map<string,{S.EVIDENCE}>")
    asked = f.responses.select(F.col("notice_id").alias("id")).distinct()
    # the stored map already has a vagas record; where new evidence exists it must win
    stored = asked.withColumn("informacoes_extracao_evidence", F.map_filter(old, lambda k, v: k == "valor_bolsa"))
    out = S.merge_evidence(stored, S.evidence_records(found))
    rows = F.transform(F.array_sort(F.map_entries("informacoes_extracao_evidence")), lambda x: F.concat(x["key"], F.lit("="), x["value"]["source"], F.lit(":"), x["value"]["snippet"], F.lit(":"), F.array_join(x["value"]["document_ids"], ",")))
    return out.select(F.col("id").alias("notice_id"), F.array_join(rows, ";").alias("evidence"))


_WON = f"{_FIRST_ID}, w AS (SELECT notice_id, field, arg_min(value, {_ORDER}) FILTER (WHERE value IS NOT NULL) AS value FROM fu GROUP BY 1, 2)"


def _results(f):
    resolved, still_open = S.source_cascade(_first(f))
    return resolved.select("notice_id", "field", "value").unionByName(still_open.select("notice_id", "field"), allowMissingColumns=True)


@query("apply_patch", "notices responses", f"""WITH {_WON}, pv AS (SELECT notice_id, bool_or(value IS NOT NULL) AS useful, {', '.join(f"max(value) FILTER (WHERE field = '{c}') AS v_{c}, bool_or(field = '{c}') AS p_{c}" for c in FIELDS)} FROM w GROUP BY 1)
SELECT id, {', '.join(f"CASE WHEN p_{c} THEN {'CAST(v_' + c + ' AS BOOLEAN)' if c.startswith('is_') else 'v_' + c} ELSE {c} END AS {c}" for c in FIELDS)}, strftime(CASE WHEN useful THEN TIMESTAMP '{STAMP}' ELSE informacoes_processadas_em END, '%Y-%m-%d') AS stamped FROM notices LEFT JOIN pv ON notices.id = pv.notice_id""")
def apply_patch(f):
    out = S.apply_patch(f.notices, _results(f), STAMP)
    return out.select("id", *FIELDS, F.date_format("informacoes_processadas_em", "yyyy-MM-dd").alias("stamped"))


_WORK = {"deadline_fixed": "id % 6 = 3", "stamped": "informacoes_processadas_em IS NOT NULL", "has_text": "id % 8 <> 0", "patched": "id % 3 <> 0", "error": "id % 5 = 0", "saved": "id % 2 = 0"}


@query("process_outcomes", "notices", "WITH " + _STATE + ", w AS (SELECT *, " + ", ".join(f"{v} AS w_{k}" for k, v in _WORK.items()) + """ FROM st)
SELECT CASE WHEN needed = '' AND NOT w_stamped THEN 'stamp_only' WHEN needed = '' AND w_deadline_fixed THEN 'ok' WHEN needed = '' THEN 'skip_complete' WHEN NOT w_has_text THEN 'skip_no_documents' WHEN w_error AND w_patched AND w_saved THEN 'ok_partial' WHEN w_error THEN 'fail'
 WHEN w_patched OR w_deadline_fixed THEN 'ok' ELSE 'skip_no_update' END AS status, count(*) AS n FROM w GROUP BY 1""")
def process_outcomes(f):
    flags = f.notices.select("id", *[F.expr(v).alias(k) for k, v in _WORK.items()])
    work = S.needs_extraction(f.notices).join(flags, "id")
    return S.outcome_totals(S.process_outcomes(work))


# stipend answers of every status
STIPENDS = """SELECT event_id, event_id % 8 AS form, event_id % 100 AS prompt_tokens, event_id % 10 AS completion_tokens, CASE event_id % 8 WHEN 0 THEN 'x {"valor_bolsa":"ATP-A: R$ 700,00/mês; ATP-B: null","evidencia":"Bolsa de  R$ 700,00 mensais"} y' WHEN 1 THEN '{"valor_bolsa":null}'
 WHEN 2 THEN '{"valor_bolsa":"setecentos","evidencia":"bolsa"}' WHEN 3 THEN '{"valor_bolsa":"R$ 700,00/mês","evidencia":"não está"}' WHEN 4 THEN '{"valor_bolsa":"R$ 900,00/mês","evidencia":"bolsa de R$ 700,00 mensais"}' WHEN 5 THEN '{"valor_bolsa":"R$ 50,00","evidencia":"prêmio de R$ 50,00"}' WHEN 6 THEN 'sem json' ELSE '{"valor_bolsa":"R$ 1,00"}' END AS raw,
 CASE event_id % 8 WHEN 7 THEN ' ' ELSE 'o edital paga bolsa de r$ 700,00 mensais e prêmio de R$ 50,00, nº '||CAST(event_id AS STRING) END AS contexto FROM events"""


def _stipends(f):
    return f.spark.sql(STIPENDS.replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}"), events=f.events)


_SV = f"sv AS ({STIPENDS}), ss AS (SELECT *, CASE form WHEN 0 THEN 'ok' WHEN 1 THEN 'sem_valor' WHEN 2 THEN 'rejeitado_sem_R$' WHEN 3 THEN 'rejeitado_evidencia_ausente' WHEN 4 THEN 'rejeitado_numero_diferente' WHEN 5 THEN 'rejeitado_nao_mensal' WHEN 6 THEN 'json_invalido' ELSE 'sem_trechos' END AS status FROM sv)"


@query("validate_stipend", "", f"WITH {_SV} SELECT event_id, status, CASE form WHEN 0 THEN 'ATP-A: R$ 700,00/mês' WHEN 2 THEN 'setecentos' WHEN 3 THEN 'R$ 700,00/mês' WHEN 4 THEN 'R$ 900,00/mês' WHEN 5 THEN 'R$ 50,00' WHEN 7 THEN 'R$ 1,00' END AS valor FROM ss")
def validate_stipend(f):
    return S.validate_stipend(_stipends(f)).select("event_id", "status", "valor")


@query("summarize_extraction", "", f"WITH {_SV} SELECT status, count(*) AS n, round(sum(prompt_tokens * 0.3 / 1e6 + completion_tokens * 2.5 / 1e6), 6) AS cost_usd FROM ss GROUP BY 1")
def summarize_extraction(f):
    return S.summarize_extraction(S.validate_stipend(_stipends(f))).withColumn("cost_usd", F.round("cost_usd", 6))


PROFILES = """SELECT event_id, event_id % 5 AS form, CASE event_id % 5 WHEN 0 THEN '{"prazo_execucao_meses":24,"valor_global_projeto":500000.4,"num_parcelas":99,"transferegov":true,"exige_obra":true,"evidencias":{"prazo_execucao_meses":"Prazo de 24 meses","valor_global_projeto":"até R$ 500 mil","num_parcelas":"x","transferegov":"pelo TransfereGov","exige_obra":"poderão incluir obras"}}'
 WHEN 1 THEN '{"clt":false,"pd_inovacao":"sim","prazo_execucao_meses":12,"evidencias":{"clt":"vedado pagamento CLT","prazo_execucao_meses":"inventado"}}' WHEN 2 THEN 'nada' WHEN 3 THEN '{"clt":null}' ELSE '{"exige_obra":true,"evidencias":{"exige_obra":"construção da  sede"}}' END AS raw,
 'prazo de 24 meses, até R$ 500 mil, pelo TransfereGov; poderão incluir obras; vedado pagamento CLT; construção da sede '||CAST(event_id AS STRING) AS contexto FROM events"""


@query("sanitize_profile", "", f"""WITH pr AS ({PROFILES}) SELECT event_id, CASE form WHEN 2 THEN 'json_invalido' WHEN 3 THEN 'sem_dados' ELSE 'ok' END AS status, CAST(CASE form WHEN 0 THEN 24 END AS DOUBLE) AS meses, CAST(CASE form WHEN 0 THEN 500000 END AS DOUBLE) AS valor, CASE form WHEN 0 THEN true END AS transferegov,
 CASE form WHEN 4 THEN true END AS exige_obra, CASE form WHEN 1 THEN false END AS clt, CASE form WHEN 0 THEN 'exige_obra:evidencia_fraca' WHEN 1 THEN 'prazo_execucao_meses' ELSE '' END AS rejeitados FROM pr""")
def sanitize_profile(f):
    rows = f.spark.sql(PROFILES.replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}"), events=f.events)
    out = S.sanitize_profile(rows)
    return out.select(
        "event_id", "status", F.col("perfil.prazo_execucao_meses").alias("meses"), F.col("perfil.valor_global_projeto").alias("valor"), "perfil.transferegov", "perfil.exige_obra", "perfil.clt",
        F.array_join("rejeitados", ",").alias("rejeitados"),
    )


@query("extra_extract_candidates", "notices attachments catalogue", f"""SELECT 'stipend' AS kind, id FROM notices WHERE valor_bolsa IS NULL AND {d.has("concat_ws(' ', titulo, valor_projeto, sobre_programa, descricao, criterios_elegibilidade, timeline_estimada)", 'bolsa')} AND id IN (SELECT edital_id FROM attachments WHERE is_processed)
UNION ALL SELECT 'profile', id FROM catalogue WHERE id % 3 <> 0""")
def extra_extract_candidates(f):
    stipend = S.stipend_candidates(f.notices, f.attachments).select(F.lit("stipend").alias("kind"), "id")
    cat = f.catalogue.select("id", F.when(F.col("id") % 3 == 0, "{}").alias("perfil_execucao"))
    return stipend.unionByName(S.profile_candidates(cat).select(F.lit("profile").alias("kind"), "id"))


def _evidence(source, snippet):
    """An evidence record that names no file."""
    nothing = F.lit(None)
    return F.struct(F.lit(source).alias("source"), snippet.alias("snippet"), nothing.cast("array<string>").alias("document_ids"), nothing.cast("string").alias("document_id"), nothing.cast("int").alias("chunk_index"))


def _extra_fields(f):
    """Both snapshots after stipends, re-extracted values and profiles; every second notice already holds evidence for its places."""
    stipends = S.validate_stipend(_stipends(f)).where("status = 'ok'")
    stipends = stipends.select(F.col("event_id").alias("id"), F.col("valor").alias("value"), _evidence("stipend", F.col("evidencia")).alias("evidence"))
    # the smaller of two answers for one notice is overruled
    said = f.events.where("event_id % 5 = 1").select(F.col("event_id").alias("id"), F.explode(F.array(F.lit("R$ 1,00"), F.concat(F.lit("R$ 9"), F.col("event_id").cast("string"), F.lit(",00")))).alias("value"))
    values = said.withColumn("evidence", _evidence("value", F.col("value")))
    rows = f.spark.sql(PROFILES.replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}"), events=f.events)
    profiles = S.accepted_profiles(S.sanitize_profile(rows.withColumnRenamed("event_id", "id")))
    held = F.when(F.col("id") % 2 == 0, F.create_map(F.lit("vagas"), _evidence("topk", F.lit("40 vagas")))).cast(f"map<string,{S.EVIDENCE}>")
    none = F.lit(None).cast("string").alias("perfil_execucao")
    notices = f.notices.select("id", "valor_bolsa", "valor_projeto", none, held.alias("informacoes_extracao_evidence"))
    return S.apply_extra_fields(notices, f.catalogue.select("id", "valor_projeto", none), stipends, values, profiles)


@query("apply_extra_fields", "notices", f"WITH {_SV}, a AS (SELECT event_id AS id FROM ss WHERE status = 'ok') SELECT n.id, CASE WHEN a.id IS NOT NULL THEN 'ATP-A: R$ 700,00/mês' ELSE valor_bolsa END AS valor_bolsa FROM notices n LEFT JOIN a ON a.id = n.id")
def apply_extra_fields(f):
    return _extra_fields(f)[0].select("id", "valor_bolsa")


_EXTRA = f"""WITH {_SV}, pr AS ({PROFILES}), a AS (SELECT event_id AS id FROM ss WHERE status = 'ok'), v AS (SELECT event_id AS id, 'R$ 9'||CAST(event_id AS VARCHAR)||',00' AS value FROM events WHERE event_id % 5 = 1),
p AS (SELECT event_id AS id, CAST(CASE form WHEN 0 THEN 24 END AS DOUBLE) AS meses, CASE form WHEN 0 THEN 'pelo TransfereGov' END AS transferegov FROM pr WHERE form IN (0, 1, 4)),
both_ AS (SELECT 'notices' AS snapshot, id, valor_projeto FROM notices UNION ALL SELECT 'catalogue', id, valor_projeto FROM catalogue)
SELECT snapshot, b.id, coalesce(v.value, b.valor_projeto) AS valor_projeto, p.id IS NOT NULL AS has_profile, meses, transferegov,
 CASE WHEN snapshot = 'notices' THEN concat_ws(',', CASE WHEN b.id % 2 = 0 THEN 'vagas=40 vagas' END, CASE WHEN a.id IS NOT NULL THEN 'valor_bolsa=Bolsa de  R$ 700,00 mensais' END, CASE WHEN v.id IS NOT NULL THEN 'valor_projeto='||v.value END) END AS evidence
FROM both_ b LEFT JOIN a ON a.id = b.id LEFT JOIN v ON v.id = b.id LEFT JOIN p ON p.id = b.id"""


@query("apply_extra_fields_snapshots", "notices catalogue", _EXTRA)
def apply_extra_fields_snapshots(f):
    notices, catalogue = _extra_fields(f)
    entries = F.map_entries("informacoes_extracao_evidence")
    # array_join of null is null: a notice without any evidence shows an empty text
    shown = F.array_sort(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]["snippet"])))
    pick = lambda df, name, evidence: df.select(
        F.lit(name).alias("snapshot"), "id", "valor_projeto", F.col("perfil_execucao").isNotNull().alias("has_profile"), F.get_json_object("perfil_execucao", "$.prazo_execucao_meses").cast("double").alias("meses"),
        F.get_json_object("perfil_execucao", "$.evidencias.transferegov").alias("transferegov"), evidence.alias("evidence"),
    )
    return pick(notices, "notices", F.coalesce(F.array_join(shown, ","), F.lit(""))).unionByName(pick(catalogue, "catalogue", F.lit(None).cast("string")))
