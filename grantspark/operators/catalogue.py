"""Audit resolution and publication."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions.deadlines import phases
from ..functions.echo import strip_echo
from ..functions.frames import compute
from ..functions.money import is_structured, json_fields
from ..functions.text import blank, has, let, none_if_blank, says, squish, strip
from ..session import materialize
from .deadlines import SEARCHED, is_active, text_is_active
from .fields import BOOLEAN_FIELDS, members, timeline_json
from .work import extracted_fields, meaningful

# Fields audited even when empty.
ALWAYS_AUDITED = ("prazo_inscricao", "valor_projeto", "sobre_programa", "criterios_elegibilidade")
MIN_SUMMARY = 50


def maybe(c: Column | str) -> Column:
    """Collapsed text, NULL for nothing or 'não informado'."""
    return let(squish(c), lambda t: F.when(~says(t, "", "não informado"), t))


def site_phases(raw: Column | str) -> Column:
    """Phases as the catalogue keeps them: any non-empty part suffices."""
    mapped = F.transform(
        phases(raw),
        lambda f: F.struct(
            maybe(f["nome"]).alias("nome"), maybe(f["prazo"]).alias("prazo"), maybe(f["status"]).alias("status"), maybe(f["data_inicio"]).alias("data_inicio"),
            F.coalesce(maybe(f["data_fim"]), maybe(f["fim"])).alias("data_fim"),
        ),
    )
    kept = F.filter(mapped, lambda f: F.coalesce(f["nome"], f["prazo"], f["status"], f["data_inicio"], f["data_fim"]).isNotNull())
    return let(kept, lambda fs: F.when(F.size(fs) > 0, fs))


def audit_targets(notices: DataFrame, evidence: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (notice, field): audit, or why it is skipped; and whether evidence can be asked first. ``keep`` names notice columns to carry along."""
    cells = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("before"), meaningful(f).alias("meaningful"), F.lit(f in ALWAYS_AUDITED).alias("always")) for f in FIELDS
    ])
    rows = notices.select("id", *keep, F.inline(cells))
    structured = (F.col("field") == "valor_projeto") & is_structured(json_fields("before"))
    action = F.when(structured, "skip_structured").when(F.col("always") | F.col("meaningful"), "audit").otherwise("skip_empty")
    rows = rows.withColumn("action", action).withColumn("before", F.when(F.col("meaningful"), F.col("before"))).drop("always")
    if evidence is None:
        return rows
    has_snippet = evidence.where("trim(snippet) <> ''").select("id", "field", F.lit(True).alias("evidence_first")).distinct()
    return rows.join(has_snippet, ["id", "field"], "left").na.fill(False, ["evidence_first"])


def parse_audits(responses: DataFrame) -> DataFrame:
    """Audit answers (notice_id, field, batch, raw): decision, reason, typed value and validity."""
    r = compute(responses, m=members("raw"))
    r = compute(r, v=F.try_element_at("m", F.col("field")), a=F.from_json(F.to_json(F.try_element_at("m", F.lit("_audit"))), "struct<decision: string, reason: string>"))
    said = F.lower(blank("a.decision"))
    r = compute(r, said=said, kind=F.schema_of_variant("v"), text=F.expr("CASE WHEN schema_of_variant(v) IN ('STRING', 'BOOLEAN') THEN CAST(v AS STRING) ELSE to_json(v) END"))
    r = compute(r, fases=F.when(F.col("field") == "timeline_estimada", site_phases("text")))
    null_value = (F.col("said") == "reject") | (F.col("kind") == "VOID")
    boolean, timeline = F.col("field").isin(*BOOLEAN_FIELDS), F.col("field") == "timeline_estimada"
    shape = F.coalesce(F.forall("fases", lambda f: f["nome"].isNotNull()), F.lit(False))
    typed = F.when(boolean, F.col("kind") == "BOOLEAN").when(timeline, shape).otherwise(F.col("kind") == "STRING")
    missing = F.col("kind").isNull() & (F.col("said") != "reject")
    ok = F.col("m").isNotNull() & ~missing & (null_value | F.coalesce(typed, F.lit(False)))
    value = F.when(~null_value & typed, F.when(timeline, timeline_json(F.col("fases"))).when(boolean, F.col("text")).otherwise(maybe("text")))
    decision = F.coalesce(none_if_blank("said"), F.when(ok, "accept").otherwise("unknown"))
    reason = F.when(missing, F.coalesce(none_if_blank("a.reason"), F.lit("missing_field_in_json"))).otherwise(blank("a.reason"))
    return r.select(*responses.columns, ok.alias("ok"), F.when(ok, value).alias("value"), decision.alias("decision"), reason.alias("reason"))


def resolve_audits(parsed: DataFrame) -> DataFrame:
    """First accept or replace in batch order; a reject counts only if none, the last one; else the last answer."""
    p = parsed.where(~F.coalesce("timed_out", F.lit(False))) if "timed_out" in parsed.columns else parsed
    answer = F.struct("ok", "value", "decision", "reason", "batch")
    final = F.col("ok") & F.col("decision").isin("accept", "replace")
    rejected = F.col("ok") & (F.col("decision") == "reject")
    best = F.coalesce(
        F.min_by(F.when(final, answer), F.when(final, F.col("batch"))),
        F.max_by(F.when(rejected, answer), F.when(rejected, F.col("batch"))),
        F.max_by(answer, "batch"),
    )
    return p.groupBy("notice_id", "field").agg(best.alias("a")).select("notice_id", "field", "a.*")


def field_status(targets: DataFrame, resolved: DataFrame, notices: DataFrame) -> DataFrame:
    """kept, cleared, corrected or inconclusive per audited field, its final value and the update it asks for."""
    r = resolved.select(F.col("notice_id").alias("id"), "field", F.coalesce("ok", F.lit(False)).alias("ok"), "value")
    t = targets.join(r, ["id", "field"], "left").join(notices.select("id", "numero", "fonte"), "id", "left")
    free = ~F.col("field").isin(*BOOLEAN_FIELDS) & ~F.trim(blank("value")).rlike(r"^[{\[]")
    cleaned = F.when(free, none_if_blank(strip_echo("value", "numero", "fonte"))).otherwise(F.col("value"))
    t = compute(t, audited=F.coalesce((F.col("action") == "audit") & F.col("ok"), F.lit(False)), cleaned=cleaned)
    final = F.when(F.col("audited"), F.col("cleaned")).otherwise(F.col("before"))
    status = (
        F.when(F.col("action") != "audit", "skipped")
        .when(~F.col("audited"), "inconclusive")
        .when(F.col("cleaned").isNull() & F.col("before").isNotNull(), "cleared")
        .when(~F.col("cleaned").eqNullSafe(F.col("before")), "corrected")
        .otherwise("kept")
    )
    t = t.withColumn("status", status).withColumn("after", final)
    update = F.when(F.col("status") == "cleared", "null").when((F.col("status") == "corrected") & F.col("after").isNotNull(), "value")
    return t.select("id", "field", "before", "after", "status", update.alias("update"))


def format_catalogue(notices: DataFrame, validated_at: datetime) -> DataFrame:
    """Catalogue rows: collapsed texts, description falling back to the summary without bold marks."""
    summary = maybe("sobre_programa")
    described = F.coalesce(maybe("descricao"), none_if_blank(strip(F.replace(summary, F.lit("**"), F.lit("")))))
    c = compute(
        notices, descricao=described, sobre_programa=summary, timeline_estimada=timeline_json(site_phases("timeline_estimada")), titulo=F.coalesce(maybe("titulo"), strip("titulo")),
        fonte=F.coalesce(maybe("fonte"), F.col("fonte")),
        **{k: maybe(k) for k in ("numero", "status", "area", "orgao", "link", "valor_projeto", "prazo_inscricao", "localizacao", "vagas", "criterios_elegibilidade")},
    )
    c = c.withColumnRenamed("informacoes_processadas_em", "origem_informacoes_processadas_em")
    return c.withColumn("validado_em", F.lit(validated_at))


def presentability(rows: DataFrame, as_of: date) -> DataFrame:
    """Reasons a row cannot be published; none means it can."""
    active = compute(rows, active=is_active(as_of, text_is_active(as_of, tuple(c for c in SEARCHED if c != "numero"))))
    no_deadline = ~meaningful("prazo_inscricao")
    summary = strip(F.coalesce(none_if_blank("sobre_programa"), F.col("descricao")))
    useful = F.coalesce(
        *[none_if_blank(c) for c in ("valor_projeto", "prazo_inscricao", "sobre_programa", "criterios_elegibilidade", "timeline_estimada", "localizacao", "vagas")],
        F.col("is_researcher").cast("string"), F.col("is_company").cast("string"),
    ).isNotNull()
    checks = [
        ("titulo_curto", F.length(strip("titulo")) < 5),
        ("link_invalido", ~has(strip("link"), r"^https?:\/\/")),
        ("fonte_ausente", strip("fonte") == ""),
        ("resumo_insuficiente", F.length(summary) < MIN_SUMMARY),
        ("publico_alvo_exclui_pesquisador_e_empresa", F.coalesce(~F.col("is_researcher") & ~F.col("is_company"), F.lit(False))),
        ("sem_prazo_inscricao", no_deadline & ~F.col("active")),
        ("prazo_encerrado", ~F.col("active")),
    ]
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]))
    reasons = F.when(~useful, F.array(F.lit("sem_campos_uteis"))).otherwise(reasons)
    out = active.withColumn("reasons", reasons)
    return out.withColumn("presentable", F.size("reasons") == 0).drop("active")


def publish_catalogue(catalogue: DataFrame, notices: DataFrame, as_of: date, validated_at: datetime, statuses: DataFrame | None = None) -> DataFrame:
    """Next catalogue snapshot: presentable rows replace or join the stored ones, with their report."""
    rows = presentability(format_catalogue(extracted_fields(notices), validated_at), as_of).where("presentable")
    if statuses is not None:
        # nine fields per notice at most
        per = statuses.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("field", "status", "before", "after"))).alias("fields"))
        rows = rows.join(per, "id", "left")
    else:
        rows = rows.withColumn("fields", F.lit(None).cast("array<struct<field: string, status: string, before: string, after: string>>"))
    report = F.to_json(F.struct(F.date_format("validado_em", "yyyy-MM-dd'T'HH:mm:ss").alias("validated_at"), F.col("extracted").alias("extracted_fields"), F.lit(True).alias("presentable"), "fields"))
    # stored, as both parts below read it: judging a row costs far more than writing it
    new = materialize(rows.withColumn("validation_report", report).drop("extracted", "fields", "reasons", "presentable"), "published")
    kept = catalogue.join(new.select("id"), "id", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def funnel_stats(notices: DataFrame, catalogue: DataFrame, attachments: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of totals and shares along the way from notice to catalogue."""
    n = notices.agg(
        F.count("*").alias("notices"), F.count("processado_em").alias("pdf_processed"), F.count("informacoes_processadas_em").alias("with_info"),
        F.count_if(F.col("informacoes_processadas_em").isNull()).alias("pending"),
    )
    total = lambda df: df.agg(F.count("*")).scalar()
    n = n.withColumns({"catalogue": total(catalogue), "attachments": total(attachments), "chunks": total(chunks)})
    share = lambda c: F.when(F.col("notices") > 0, F.floor(F.lit(100.0) * F.col(c) / F.col("notices") + 0.5)).otherwise(0)
    return n.withColumn("backlog", F.greatest(F.lit(0), F.col("with_info") - F.col("catalogue"))).withColumns(
        {"pdf_pct": share("pdf_processed"), "info_pct": share("with_info"), "catalogue_pct": share("catalogue")}
    )
