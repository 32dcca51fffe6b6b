"""Audits and repairs of stored data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions.deadlines import is_missing, phases
from ..functions.echo import STILL_SUSPECT, strip_echo
from ..functions.frames import compute
from ..functions.text import blank, has, let, none_if_blank, squish, strip
from ..functions.titles import build_title, is_supplement, is_weak, link_text
from .chunks import file_key

# Labels that are no title, and words that make a short one acceptable.
BAD_TITLE = (
    r"^(ADENDO|RETIFICA|ERRATA|ANEXO|RESULTADO|HOMOLOGA|AVISO|ESCLARECIMENTO|EXTRATO|NOTA\s+EXPLICATIVA|ATA\s+DE|Pesquisadores|Empresas|Novo"
    r"|FUNCAP|FACEPE|FAPERN|FINEP|SECTI|Aberto|Encerrado|•)$"
)
BADGE = r"^(pesquisadores|empresas|novo|aberto|encerrado|funcap|facepe|fapern|finep|secti|•|—|-)$"
TITLE_WORD = r"edital|chamada|programa|bolsa|seleção|selecao"


def _filled(c: str) -> Column:
    return strip(c) != ""


def source_completeness(notices: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Per source how many notices have each field; expected sources without notices, and extra sources."""
    vl = F.when(_filled("valor_projeto"), F.length("valor_projeto")).otherwise(0)
    per = notices.groupBy(F.coalesce(none_if_blank(F.trim("fonte")), F.lit("(sem fonte)")).alias("fonte")).agg(
        F.count("*").alias("total"), F.count_if(_filled("valor_projeto")).alias("with_value"), F.count_if(_filled("prazo_inscricao")).alias("with_deadline"),
        F.count_if(_filled("sobre_programa")).alias("with_summary"), F.count_if(_filled("criterios_elegibilidade")).alias("with_criteria"),
        F.count("informacoes_processadas_em").alias("processed"), F.count_if(vl > 500).alias("value_overflow"), F.max(vl).cast("long").alias("max_value_chars"),
    )
    names = notices.sparkSession.createDataFrame([(x, True) for x in expected], "fonte string, expected boolean")
    out = per.join(names, "fonte", "full_outer")
    return out.na.fill(0).na.fill(False, ["expected"])


def attachment_coverage(notices: DataFrame, attachments: DataFrame) -> DataFrame:
    """Per source: with files, with all files processed, without value or deadline, unprocessed."""
    files = attachments.groupBy(F.col("edital_id").alias("id")).agg(F.count("*").alias("files"), F.count_if(F.coalesce("is_processed", F.lit(False))).alias("done"))
    n = notices.select("id", "fonte", "valor_projeto", "prazo_inscricao", "informacoes_processadas_em").join(files, "id", "left")
    return n.groupBy(F.coalesce("fonte", F.lit("?")).alias("fonte")).agg(
        F.count("*").alias("total"), F.count("files").alias("with_pdf"), F.count_if(F.col("done") >= F.col("files")).alias("pdf_done"),
        F.count_if(F.col("files").isNull()).alias("without_pdf"), F.count_if(~_filled("valor_projeto")).alias("no_value"), F.count_if(~_filled("prazo_inscricao")).alias("no_deadline"),
        F.count_if(F.col("informacoes_processadas_em").isNull()).alias("unprocessed"),
    )


def suspicious_titles(rows: DataFrame) -> DataFrame:
    """Titles that do not name a call, with the first reason that fits."""
    r = compute(rows, _t=squish("titulo"), _s=is_supplement("titulo"))
    reason = (
        F.when(F.length("_t") < 4, "vazio/curto")
        .when((F.length("_t") <= 12) & has("_t", BADGE), "badge/rótulo")
        .when(has("_t", BAD_TITLE), "padrão inválido")
        .when(F.col("_s"), "adendo/suplemento")
        .when(F.upper("_t") == F.upper(blank("fonte")), "igual à fonte")
        .when(~F.col("_t").rlike(r"\d") & (F.length("_t") < 25) & ~has("_t", TITLE_WORD), "sem número nem palavra-chave")
    )
    return compute(r, reason=reason).where("reason IS NOT NULL").drop("_t", "_s")


def repair_titles(rows: DataFrame) -> DataFrame:
    """Proposed titles for bad ones that have a number."""
    r = compute(rows, _t=link_text("titulo"))
    bad = is_supplement("_t") | is_weak("_t") | (F.length("_t") < 12)
    r = compute(r, proposed=F.when(bad & (F.trim(blank("numero")) != ""), build_title("_t", "numero", "fonte")))
    return r.where("proposed IS NOT NULL AND NOT proposed <=> titulo").drop("_t")


def corrupt_index(attachments: DataFrame, health: DataFrame, since: datetime | None = None, limit: int | None = None) -> DataFrame:
    """Files flagged processed whose index is not healthy: newest file row first, one per file key."""
    a = attachments if since is None else attachments.where(F.col("criado_em") >= F.lit(since))
    keyed = a.withColumn("file_key", file_key()).where("file_key <> ''")
    age = F.struct("criado_em", "id") if "criado_em" in a.columns else F.struct("id")
    newest = keyed.groupBy("file_key").agg(F.max_by(F.struct("id", "edital_id", "is_processed"), age).alias("r")).select("file_key", "r.*")
    h = health.select(F.col("file_id").alias("file_key"), "total", "fully_indexed")
    bad = newest.where("is_processed").join(h, "file_key", "left").where(~F.coalesce("fully_indexed", F.lit(False)))
    bad = bad.select("file_key", "id", "edital_id", F.coalesce("total", F.lit(0)).alias("total"))
    return bad.orderBy("file_key").limit(limit) if limit else bad


def repair_corrupt_index(corrupt: DataFrame, attachments: DataFrame, chunks: DataFrame, notices: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Next attachments, chunks and notices: flags reset, chunks dropped, stamps cleared."""
    keys = corrupt.select("file_key")
    flagged = attachments.withColumn("file_key", file_key()).join(keys.withColumn("_bad", F.lit(True)), "file_key", "left")
    a = flagged.withColumn("is_processed", F.when(F.col("_bad"), False).otherwise(F.col("is_processed"))).select(*attachments.columns)
    c = chunks.join(keys.withColumnRenamed("file_key", "file_id"), "file_id", "left_anti")
    return a, c, reset_stamps(notices, corrupt.select(F.col("edital_id").alias("id")))


def reset_stamps(notices: DataFrame, ids: DataFrame) -> DataFrame:
    at = "informacoes_processadas_em"
    hit = notices.join(ids.distinct().withColumn("_hit", F.lit(True)), "id", "left")
    return hit.withColumn(at, F.when(F.col("_hit").isNull(), F.col(at))).select(*notices.columns)


def _stored_useful(f: str) -> Column:
    if f in ("is_researcher", "is_company"):
        return F.col(f).isNotNull()
    if f == "timeline_estimada":
        return F.coalesce(F.size(phases(f)) > 0, F.lit(False))
    return ~is_missing(f)


def false_stamps(notices: DataFrame, catalogue: DataFrame, chunked: DataFrame | None = None) -> DataFrame:
    """Stamped notices outside the catalogue that have no useful field."""
    useful = F.lit(False)
    for f in FIELDS:
        useful = useful | _stored_useful(f)
    n = notices.where(F.col("informacoes_processadas_em").isNotNull() & ~useful).join(catalogue.select("id"), "id", "left_anti")
    return n.join(chunked.select("id").distinct(), "id", "left_semi") if chunked is not None else n


# Fields cleaned of echoes, and those whose bold marks may go.
ECHO_FIELDS = ("localizacao", "sobre_programa", "criterios_elegibilidade", "prazo_inscricao", "vagas", "valor_projeto", "descricao")
BOLD_FIELDS = ("descricao", "localizacao", "vagas", "prazo_inscricao")


def _clean_json(value: Column) -> Column:
    """Echoes removed from the texts inside JSON; emptied texts become null and leave their array."""
    tokens = F.regexp_extract_all(value, F.lit(r'"(?:[^"\\]|\\.)*"(?:\s*:)?|[^"]+'), F.lit(0))

    def one(tok):
        text = F.get(F.from_json(F.concat(F.lit("["), tok, F.lit("]")), "array<string>"), F.lit(0))
        new = strip_echo(text, "numero", "fonte")
        inner = F.regexp_replace(F.to_json(F.array(new)), r"^\[|\]$", "")
        return F.when(~tok.startswith('"') | tok.rlike(r":$"), tok).when(new == "", F.lit("null")).otherwise(inner)

    joined = F.array_join(F.transform(tokens, one), "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(joined, r"(?<=\[)null,", ""), r",null(?=[,\]])", ""), r"(?<=\[)null(?=\])", "")


def clean_echoes(notices: DataFrame, strip_bold: bool = False, fields: Sequence[str] = ECHO_FIELDS) -> DataFrame:
    """Changed and still-suspect values (id, field, before, after, changed, nulled, suspect)."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("before")) for f in fields])
    rows = notices.select("id", "numero", "fonte", F.inline(cells)).where("before IS NOT NULL")
    is_json = F.trim("before").rlike(r"^[{\[]") & F.try_parse_json("before").isNotNull()
    text = strip_echo("before", "numero", "fonte")
    bare = let(text, lambda t: F.when(F.contains(t, F.lit("**")), F.trim(F.regexp_replace(F.replace(t, F.lit("**"), F.lit("")), r"[ \t]{2,}", " "))).otherwise(t))
    text = F.when(F.col("field").isin(*BOLD_FIELDS), bare).otherwise(text) if strip_bold else text
    r = compute(rows, next=F.when(is_json, _clean_json(F.trim("before"))).otherwise(text))
    r = compute(r, after=none_if_blank("next"), changed=F.col("next") != strip("before"))
    r = r.withColumn("suspect", has(F.when(F.col("changed"), F.col("after")).otherwise(F.col("before")), STILL_SUSPECT))
    return r.where("changed OR suspect").select("id", "field", "before", "after", "changed", (F.col("changed") & F.col("after").isNull()).alias("nulled"), "suspect")


def recent_sample(notices: DataFrame, attachments: DataFrame, n: int = 8) -> DataFrame:
    """The newest notices with what they have."""
    newest = notices.orderBy(F.desc("criado_em"), "id").limit(n)
    # at most n ids decide which attachments are counted
    files = attachments.select(F.col("edital_id").alias("id")).join(F.broadcast(newest.select("id")), "id", "left_semi").groupBy("id").agg(F.count("*").alias("pdfs"))
    return newest.join(files, "id", "left").select(
        "id", "fonte", F.substring(blank("titulo"), 1, 55).alias("titulo"), _filled("valor_projeto").alias("has_value"), _filled("prazo_inscricao").alias("has_deadline"),
        F.coalesce("pdfs", F.lit(0)).alias("pdfs"), F.col("informacoes_processadas_em").isNotNull().alias("processed"),
    )
