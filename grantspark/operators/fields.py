"""Model answers to field values: parsing, cascade, state and patches."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions.deadlines import MISSING, is_missing, phases
from ..functions.echo import strip_echo
from ..functions.frames import compute
from ..functions.text import WB_END, WB_START, blank, grab, has, let, none_if_blank, says, squish, strip, upto
from .values import compact_value, value_quality

BOOLEAN_FIELDS = ("is_researcher", "is_company")
JSON_FIELDS = ("valor_projeto", "timeline_estimada")
TEXT_FIELDS = tuple(f for f in FIELDS if f not in BOOLEAN_FIELDS + JSON_FIELDS)
# Stage order of a field's answers, and the least useful text.
STAGES = ("topk", "chunkscan", "window")
MIN_TEXT = 50
DATE_SIGNAL = r"\d{1,2}\s*\/\s*\d{1,2}\s*\/\s*\d{2,4}|\d{4}-\d{2}-\d{2}|\d{1,2}\s+de\s+\w+\s+de\s+\d{4}"
NOT_A_PHASE = r"documentos?\s+necess|anexos?\s+obrigat|checklist|modelo\s+de"
EVIDENCE = "struct<source: string, snippet: string, document_ids: array<string>, document_id: string, chunk_index: int>"


def json_block(raw: Column | str) -> Column:
    t = strip(raw)
    return F.coalesce(none_if_blank(strip(grab(t, r"```(?:json)?\s*([\s\S]*?)\s*```"))), t)


def members(raw: Column | str) -> Column:
    """Members of an answer's JSON object, NULL when it is not exactly one object."""
    return let(json_block(raw), lambda b: F.when(b.rlike(r"(?s)^\{.*\}$") & F.try_parse_json(b).isNotNull(), F.from_json(b, "map<string,variant>")))


def clean_phases(fs: Column, most: dict[str, int] | None = None) -> Column:
    """Phases with a name, every part trimmed, the end falling back; ``most`` may limit the characters of a part."""
    cut = lambda f, part, limit=None: none_if_blank(upto(strip(f[part]), (most or {}).get(limit or part)))
    mapped = F.transform(
        fs,
        lambda f: F.struct(
            *[cut(f, part).alias(part) for part in ("nome", "prazo", "status", "data_inicio")],
            F.coalesce(cut(f, "data_fim"), cut(f, "fim", "data_fim")).alias("data_fim"),
        ),
    )
    return F.filter(mapped, lambda f: f["nome"].isNotNull())


def timeline_useful(fs: Column) -> Column:
    """One dated phase, or two real phases with a deadline text."""

    def dated(f):
        parts = F.array(f["data_inicio"], f["data_fim"], f["prazo"])
        return F.exists(parts, lambda p: has(p, DATE_SIGNAL))

    def named(f):
        name, due = strip(f["nome"]), strip(f["prazo"])
        return (F.length(name) >= 4) & ~has(name, NOT_A_PHASE) & (due != "") & (F.lower(due) != "null")

    return let(fs, lambda f: F.coalesce(F.exists(f, dated) | (F.size(F.filter(f, named)) >= 2), F.lit(False)))


def normalized_timeline(raw: Column | str) -> Column:
    return let(clean_phases(phases(raw)), lambda fs: F.when(timeline_useful(fs), fs))


def timeline_json(fs: Column) -> Column:
    return F.when(fs.isNotNull(), F.to_json(F.struct(fs.alias("fases")), {"ignoreNullFields": "false"}))


def parse_responses(responses: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """Answers (notice_id, field, stage, batch, raw, timed_out) to typed values.

    A missing key asks for a retry. Texts lose echoed headers when ``notices`` (numero, fonte) are given;
    the raw value answer is kept as JSON for the structuring job.
    """
    r = responses
    if notices is not None:
        r = r.join(notices.select(F.col("id").alias("notice_id"), "numero", "fonte"), "notice_id", "left")
    else:
        r = r.withColumns({"numero": F.lit(None).cast("string"), "fonte": F.lit(None).cast("string")})
    r = compute(r, m=members("raw"))
    r = compute(r, has_key=F.coalesce(F.map_contains_key("m", F.col("field")), F.lit(False)), v=F.try_element_at("m", F.col("field")))
    r = compute(r, kind=F.schema_of_variant("v"), text=F.expr("CASE WHEN schema_of_variant(v) IN ('STRING', 'BOOLEAN') THEN CAST(v AS STRING) ELSE to_json(v) END"))
    is_text, is_bool = F.col("kind") == "STRING", F.col("kind") == "BOOLEAN"
    value = (
        F.when(F.col("kind").isNull() | (F.col("kind") == "VOID"), F.lit(None).cast("string"))
        .when(F.col("field").isin(*BOOLEAN_FIELDS), F.when(is_bool, F.col("text")))
        .when(F.col("field") == "timeline_estimada", timeline_json(normalized_timeline("text")))
        .when(F.col("field") == "valor_projeto", F.when(is_text | F.col("kind").startswith("OBJECT"), F.col("text")))
        .otherwise(F.when(is_text, none_if_blank(strip_echo("text", "numero", "fonte"))))
    )
    r = compute(r, value=value)
    return r.select(*responses.columns, "has_key", (~F.col("has_key")).alias("retry"), "value")


def answer_useful() -> Column:
    """Whether a parsed value ends the search of its field."""
    return F.col("value").isNotNull() & ~F.lower(squish("value")).isin(*MISSING)


def first_useful(parsed: DataFrame) -> DataFrame:
    """Earliest batch with a useful value per (notice, field, stage); timed-out batches do not count."""
    ok = answer_useful() & ~F.coalesce("timed_out", F.lit(False))
    return parsed.groupBy("notice_id", "field", "stage").agg(
        F.min_by(F.when(ok, F.col("value")), F.when(ok, F.col("batch"))).alias("value"),
        F.min(F.when(ok, F.col("batch"))).alias("batch"),
        F.bool_or(F.coalesce("timed_out", F.lit(False))).alias("timed_out"),
        F.count("*").alias("answers"),
    )


def source_cascade(stage_values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first stage with a value wins; and the pairs still open, with the next stage to ask."""
    order = F.lit(len(STAGES))
    for i, s in enumerate(STAGES):
        order = F.when(F.col("stage") == s, i).otherwise(order)
    s = stage_values.withColumn("_o", order)
    found = F.col("value").isNotNull()
    best = s.groupBy("notice_id", "field").agg(
        F.min_by(F.when(found, F.struct("stage", "value", "batch")), F.when(found, F.col("_o"))).alias("b"), F.max("_o").alias("last")
    )
    resolved = best.where("b IS NOT NULL").select("notice_id", "field", "b.stage", "b.value", "b.batch")
    nxt = F.try_element_at(F.array(*[F.lit(x) for x in STAGES]), (F.col("last") + 2).cast("int"))
    return resolved, best.where("b IS NULL").select("notice_id", "field", nxt.alias("next_stage"))


def nullish_flags(notices: DataFrame, columns: tuple[str, ...] = TEXT_FIELDS) -> DataFrame:
    """Missing and too-short flags of text columns, as rows (id, field, missing, too_short)."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns])
    rows = notices.select("id", F.inline(cells))
    return compute(rows, missing=is_missing("v"), n=F.length(squish("v"))).select(
        "id", "field", "missing", (F.col("missing") | (F.col("n") < MIN_TEXT)).alias("too_short")
    )


def field_state(notices: DataFrame) -> DataFrame:
    """Arrays of fields still to extract and of useful fields per notice."""
    n = compact_value(notices)
    q = value_quality(n.withColumn("_v", F.when(~is_missing("valor_projeto"), F.col("compacted"))), "_v", "numero")
    q = q.withColumnRenamed("plausible", "_vp").withColumn("_va", F.expr("size(lines) > 0 AND NOT any_invalid AND any_money"))
    # each text is collapsed once for all that is asked of it
    q = compute(q, _tl=timeline_useful(phases("timeline_estimada")), _none=is_missing("valor_projeto"), **{f"_t_{f}": squish(f) for f in TEXT_FIELDS})
    useful = {"valor_projeto": F.col("_va") & ~F.col("_none"), "timeline_estimada": F.col("_tl")}
    needs = {"valor_projeto": ~F.col("_vp") | F.col("_none"), "timeline_estimada": ~F.col("_tl")}
    for f in BOOLEAN_FIELDS:
        useful[f], needs[f] = F.col(f).isNotNull(), F.col(f).isNull()
    for f in TEXT_FIELDS:
        useful[f] = ~says(F.col(f"_t_{f}"), *MISSING)
        needs[f] = ~useful[f] | (F.length(f"_t_{f}") < MIN_TEXT)
    pick = lambda d: F.array_compact(F.array(*[F.when(F.coalesce(d[f], F.lit(False)), F.lit(f)) for f in FIELDS]))
    out = compute(q, needed=pick(needs), useful_fields=pick(useful))
    return out.select(*notices.columns, "needed", "useful_fields")


def needs_extraction(notices: DataFrame) -> DataFrame:
    s = field_state(notices)
    return s.select("id", "needed", (F.size("needed") > 0).alias("needs_any"), (F.size("useful_fields") > 0).alias("has_useful"))


def normalize_timeline(notices: DataFrame, column: str = "timeline_estimada") -> DataFrame:
    return compute(notices, timeline=timeline_json(normalized_timeline(column)))


def strip_prompt_echo(rows: DataFrame, column: str = "text") -> DataFrame:
    return compute(rows, stripped=strip_echo(column, "numero", "fonte"))


def evidence_records(found: DataFrame, most_chars: int | None = None) -> DataFrame:
    """Evidence per (notice, field) from (stage, context, chunk_ids, chunk_index); snippets are whole unless limited."""
    ids = F.array_distinct(F.filter(F.coalesce("chunk_ids", F.array().cast("array<string>")), lambda x: F.trim(x) != ""))
    return found.select(
        "notice_id", "field",
        F.struct(
            F.col("stage").alias("source"), upto(strip("context"), most_chars).alias("snippet"), F.when(F.size(ids) > 0, ids).alias("document_ids"),
            F.get(ids, F.lit(0)).alias("document_id"), F.col("chunk_index").cast("int").alias("chunk_index"),
        ).alias("evidence"),
    )


def merge_evidence(notices: DataFrame, evidence: DataFrame, column: str = "informacoes_extracao_evidence") -> DataFrame:
    """New evidence over the stored map, per field; a notice has at most one record per field."""
    new = evidence.groupBy(F.col("notice_id").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("field", "evidence"))).alias("_new"))
    merged = F.when(F.col("_new").isNull(), F.col(column)).otherwise(
        F.map_zip_with(F.coalesce(column, F.create_map().cast(f"map<string,{EVIDENCE}>")), "_new", lambda k, old, new: F.coalesce(new, old))
    )
    return notices.join(new, "id", "left").withColumn(column, merged).drop("_new")


def apply_patch(notices: DataFrame, results: DataFrame, stamp: datetime) -> DataFrame:
    """Sparse patch of extracted fields (notice_id, field, value); stamps only if something useful came.

    A field that was asked and stayed empty is written as empty, as the stored row was not good enough.
    """
    per = results.groupBy(F.col("notice_id").alias("id")).agg(
        *[F.max_by("value", F.when(F.col("field") == f, 1)).alias(f"_v_{f}") for f in FIELDS],
        *[F.bool_or(F.col("field") == f).alias(f"_p_{f}") for f in FIELDS],
        F.bool_or(answer_useful()).alias("_useful"),
    )
    n = notices.join(per, "id", "left")
    changed = {
        f: F.when(F.coalesce(f"_p_{f}", F.lit(False)), F.col(f"_v_{f}").cast("boolean" if f in BOOLEAN_FIELDS else "string")).otherwise(F.col(f)) for f in FIELDS
    }
    at = "informacoes_processadas_em"
    n = n.withColumns({**changed, at: F.when(F.coalesce("_useful", F.lit(False)), F.lit(stamp)).otherwise(F.col(at))})
    return n.select(*notices.columns)


def process_outcomes(work: DataFrame) -> DataFrame:
    """Status per notice from needs_any, deadline_fixed, stamped, has_text, patched, error, saved."""
    status = (
        F.when(~F.col("needs_any") & ~F.col("stamped"), "stamp_only")
        .when(~F.col("needs_any") & F.col("deadline_fixed"), "ok")
        .when(~F.col("needs_any"), "skip_complete")
        .when(~F.col("has_text"), "skip_no_documents")
        .when(F.col("error") & F.col("patched") & F.col("saved"), "ok_partial")
        .when(F.col("error"), "fail")
        .when(F.col("patched") | F.col("deadline_fixed"), "ok")
        .otherwise("skip_no_update")
    )
    return work.withColumn("status", status)


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def _norm(c: Column | str) -> Column:
    return F.lower(squish(c))


def validate_stipend(answers: DataFrame) -> DataFrame:
    """Status, value and evidence of each stipend answer (raw, contexto)."""
    a = compute(answers, m=F.from_json(none_if_blank(F.regexp_extract(blank("raw"), r"(?s)(\{.*\})", 1)), "map<string,variant>"))
    text = lambda k: F.when(F.schema_of_variant(F.try_element_at("m", F.lit(k))) == "STRING", F.try_element_at("m", F.lit(k)).cast("string"))
    kept = F.array_join(F.filter(F.split(text("valor_bolsa"), ";"), lambda s: ~has(s, WB_START + "null" + WB_END)), ";")
    a = compute(a, valor=none_if_blank(strip(kept)), evidencia=F.when(text("evidencia").isNotNull(), strip(text("evidencia"))))
    numbers = F.regexp_extract_all(blank("valor"), F.lit(r"\d{1,3}(?:\.\d{3})*,\d{2}"), F.lit(0))
    absent = none_if_blank("evidencia").isNull() | ~F.contains(_norm("contexto"), _norm("evidencia"))
    status = (
        F.when(F.trim(blank("contexto")) == "", "sem_trechos")
        .when(F.col("m").isNull(), "json_invalido")
        .when(F.col("valor").isNull(), "sem_valor")
        .when(~F.col("valor").rlike(r"R\$\s*\d"), "rejeitado_sem_R$")
        .when(absent, "rejeitado_evidencia_ausente")
        .when(~F.forall(numbers, lambda n: F.contains("evidencia", n)), "rejeitado_numero_diferente")
        .when(~has(F.concat_ws(" ", "valor", "evidencia"), "mês|mensal|mensais"), "rejeitado_nao_mensal")
        .otherwise("ok")
    )
    return a.withColumn("status", status).select(*answers.columns, "status", "valor", "evidencia")


# Plausible ranges of the profile's numbers, its flags, and wording too weak to support "true".
PROFILE_RANGES = {"prazo_execucao_meses": (1, 240), "valor_global_projeto": (1000, 5_000_000_000), "num_parcelas": (1, 60)}
PROFILE_FLAGS = ("transferegov", "exige_obra", "clt", "lei_14133_integral", "pd_inovacao")
WEAK_SUPPORT = {
    "exige_obra": (
        r"poder[ãa]o|poder[áa]|permitid|pequenas obras|reforma|adapta|recupera|conserva|moderniza|apoi[áa]ve|financi[áa]ve|exemplos|tais como"
        r"|despesas? (de capital|com)|investimentos fixos"
    ),
    "lei_14133_integral": r"regula-se|art\.?\s*5º|no que couber|impedid|impedimento de licitar|vincula[çc][ãa]o ao edital|em conformidade com",
    "clt": (
        r"v[íi]nculo (empregat[íi]cio|funcional|celetista|trabalhista) (efetivo|permanente|com a institui)|ter v[íi]nculo|possuir v[íi]nculo"
        r"|comprovar v[íi]nculo|poder[ãa]o receber bolsa"
    ),
}


def sanitize_profile(answers: DataFrame, most_chars: int | None = None) -> DataFrame:
    """Execution profile with typed, plausible and literally supported values; and what was rejected.

    Support is judged on whole snippets; only the evidence kept may be limited.
    """
    a = compute(answers, m=F.from_json(none_if_blank(F.regexp_extract(blank("raw"), r"(?s)(\{.*\})", 1)), "map<string,variant>"), ctx=_norm("contexto"))
    a = compute(a, ev=F.from_json(F.to_json(F.try_element_at("m", F.lit("evidencias"))), "map<string,string>"))
    member = lambda k: F.try_element_at("m", F.lit(k))
    snippet = lambda k: strip(F.try_element_at("ev", F.lit(k)))
    supported = lambda k: (snippet(k) != "") & F.contains("ctx", _norm(snippet(k)))
    values, rejected, used = {}, [], []
    for k, (low, high) in PROFILE_RANGES.items():
        n = member(k).try_cast("double")
        ok = F.coalesce(n.between(low, high), F.lit(False))
        values[k] = F.when(ok & supported(k), F.floor(n + F.lit(0.5)))
        rejected.append(F.when(ok & ~supported(k), F.lit(k)))
        used.append(F.when(ok & supported(k), F.struct(F.lit(k).alias("k"), upto(snippet(k), most_chars).alias("v"))))
    for k in PROFILE_FLAGS:
        typed = F.coalesce(F.schema_of_variant(member(k)) == "BOOLEAN", F.lit(False))
        flag = F.when(typed, member(k).cast("boolean"))
        weak = has(snippet(k), WEAK_SUPPORT[k]) if k in WEAK_SUPPORT else F.lit(False)
        veto = F.coalesce(flag, F.lit(False)) & weak
        values[k] = F.when(typed & supported(k) & ~veto, flag)
        rejected += [F.when(typed & ~supported(k), F.lit(k)), F.when(typed & supported(k) & veto, F.lit(f"{k}:evidencia_fraca"))]
        used.append(F.when(typed & supported(k) & ~veto, F.struct(F.lit(k).alias("k"), upto(snippet(k), most_chars).alias("v"))))
    out = compute(
        a,
        perfil=F.struct(*[v.cast("boolean" if k in PROFILE_FLAGS else "double").alias(k) for k, v in values.items()]),
        evidencias=F.map_from_entries(F.array_compact(F.array(*used))),
        rejeitados=F.array_compact(F.array(*rejected)),
    )
    status = F.when(F.trim(blank("contexto")) == "", "sem_trechos").when(F.col("m").isNull(), "json_invalido").when(F.size("evidencias") > 0, "ok").otherwise("sem_dados")
    return out.withColumn("status", status).select(*answers.columns, "status", "perfil", "evidencias", "rejeitados")


# Price per token read and written, used for the run's cost.
PRICE_IN, PRICE_OUT = 0.3 / 1e6, 2.5 / 1e6


def summarize_extraction(results: DataFrame) -> DataFrame:
    cost = F.col("prompt_tokens") * PRICE_IN + F.col("completion_tokens") * PRICE_OUT
    return results.groupBy("status").agg(F.count("*").alias("n"), F.sum(cost).alias("cost_usd"))


STIPEND_TEXTS = ("titulo", "valor_projeto", "sobre_programa", "descricao", "criterios_elegibilidade", "timeline_estimada")


def stipend_candidates(notices: DataFrame, attachments: DataFrame) -> DataFrame:
    """Notices with a processed file, stipend wording and no stipend yet."""
    done = attachments.where("is_processed").select(F.col("edital_id").alias("id")).distinct()
    n = notices.where(none_if_blank("valor_bolsa").isNull() & has(F.concat_ws(" ", *STIPEND_TEXTS), "bolsa"))
    return n.join(done, "id", "left_semi")


def profile_candidates(catalogue: DataFrame, force: bool = False, ids: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Catalogue rows without profile, or all, or exactly the given ids."""
    if ids is not None:
        out = catalogue.join(ids.select("id").distinct(), "id", "left_semi")
    else:
        out = catalogue if force else catalogue.where("perfil_execucao IS NULL")
    return out.orderBy("id").limit(limit) if limit else out


def accepted_profiles(sanitized: DataFrame) -> DataFrame:
    """(id, value) of the profiles of ``sanitize_profile`` that hold something, as JSON with their evidence."""
    value = F.to_json(F.struct("perfil.*", "evidencias"))
    return sanitized.where("status = 'ok'").select("id", value.alias("value"))


def _one_each(accepted: DataFrame) -> DataFrame:
    """One answer per id: the greatest of several."""
    rest = [c for c in accepted.columns if c != "id"]
    return accepted.where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct(*rest)).alias("_a")).select("id", "_a.*")


def _fill(rows: DataFrame, accepted: DataFrame, column: str) -> DataFrame:
    """Values (id, value) over a snapshot's column; other rows keep theirs."""
    new = accepted.select("id", F.col("value").alias("_new"))
    return rows.join(new, "id", "left").withColumn(column, F.coalesce("_new", column)).select(*rows.columns)


def apply_extra_fields(notices: DataFrame, catalogue: DataFrame, stipends: DataFrame | None = None, values: DataFrame | None = None,
                       profiles: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Next snapshots of notices and catalogue with the accepted answers; rows without one keep what they have.

    ``stipends`` and ``values`` are (id, value, evidence): both go to the notices, with the evidence merged into the stored map, values
    also to the catalogue. ``profiles`` (id, value) go to both. Of several answers for one id the greatest counts; ids that neither table
    holds change nothing.
    """
    evidence = []
    if stipends is not None:
        stipends = _one_each(stipends.select("id", "value", "evidence"))
        notices = _fill(notices, stipends, "valor_bolsa")
        evidence.append(stipends.withColumn("field", F.lit("valor_bolsa")))
    if values is not None:
        values = _one_each(values.select("id", "value", "evidence"))
        notices, catalogue = _fill(notices, values, "valor_projeto"), _fill(catalogue, values, "valor_projeto")
        evidence.append(values.withColumn("field", F.lit("valor_projeto")))
    if profiles is not None:
        profiles = _one_each(profiles.select("id", "value"))
        notices, catalogue = _fill(notices, profiles, "perfil_execucao"), _fill(catalogue, profiles, "perfil_execucao")
    if evidence:
        columns = notices.columns
        found = reduce(DataFrame.unionByName, evidence).select(F.col("id").alias("notice_id"), "field", "evidence")
        notices = merge_evidence(notices, found).select(*columns)
    return notices, catalogue
