"""Deadlines and activity of notices."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import deadlines as D
from ..functions.frames import compute
from ..functions.text import blank, let, none_if_blank, squish

SEARCHED = ("titulo", "descricao", "sobre_programa", "numero", "prazo_inscricao", "data_encerramento", "timeline_estimada")


def extract_dates(texts: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per date mention of each text."""
    return texts.select(*keep, F.posexplode(D.date_mentions(column)).alias("n", "date"))


def latest_date(texts: DataFrame, column: str) -> DataFrame:
    return compute(texts, latest=D.latest_mention(column), phase_deadline=D.phase_deadline(column), text_deadline=D.text_deadline(column))


def timeline_deadline(notices: DataFrame, column: str = "timeline_estimada") -> DataFrame:
    out = compute(notices, best=D.timeline_deadline(column))
    return out.select(*notices.columns, F.col("best.date").alias("deadline"), F.col("best.prazo").alias("phase_text"), F.col("best.nome").alias("phase_name"))


def derive_deadline(notices: DataFrame) -> DataFrame:
    out = compute(notices, best=D.timeline_deadline("timeline_estimada"))
    return compute(out, derived=D.derived_deadline(F.col("best"), "data_encerramento")).drop("best")


def normalize_deadline(notices: DataFrame, column: str = "prazo_inscricao") -> DataFrame:
    return compute(notices, normalized=D.normalized_deadline(column))


def reconcile_deadline(notices: DataFrame) -> DataFrame:
    """Existing deadline normalized, else derived; flags the rows it changes."""
    out = derive_deadline(normalize_deadline(notices))
    value = F.when(D.is_missing("prazo_inscricao"), F.col("derived")).otherwise(F.coalesce("normalized", squish("prazo_inscricao")))
    out = compute(out, reconciled=value)
    changed = F.col("reconciled").isNotNull() & ~F.col("reconciled").eqNullSafe(F.col("prazo_inscricao"))
    # an existing text that cannot be normalized is left as it is
    keeps = ~D.is_missing("prazo_inscricao") & F.col("normalized").isNull()
    return out.withColumn("changed", changed & ~keeps).drop("normalized", "derived")


def collect_deadlines(notices: DataFrame, plausible_from: int = 2010) -> DataFrame:
    """Plausible deadlines of the three sources per notice."""
    out = compute(
        notices,
        d1=D.timeline_deadline("timeline_estimada")["date"],
        d2=F.when(~D.is_missing("prazo_inscricao"), D.text_deadline("prazo_inscricao")),
        d3=D.closing_date("data_encerramento"),
    )
    ok = lambda d: (F.year(d) >= plausible_from) & F.coalesce(F.year(d) >= F.year("criado_em") - 2, F.lit(True))
    dates = F.filter(F.array("d1", "d2", "d3"), lambda d: d.isNotNull() & ok(d))
    return out.withColumn("deadlines", dates).drop("d1", "d2", "d3")


def active_patterns(spark: SparkSession, as_of: date) -> DataFrame:
    return spark.createDataFrame([(p,) for p in D.active_patterns(as_of)], "pattern string")


def search_text(columns: tuple[str, ...] = SEARCHED) -> Column:
    return F.lower(searched_text(columns))


def searched_text(columns: tuple[str, ...] = SEARCHED) -> Column:
    return F.concat_ws(" ", *[none_if_blank(blank(c)) for c in columns])


def text_is_active(as_of: date, columns: tuple[str, ...] = SEARCHED) -> Column:
    # the patterns are digits and strokes, which have no case
    return D.has_active_pattern(searched_text(columns), as_of)


def match_active_text(notices: DataFrame, as_of: date, columns: tuple[str, ...] = SEARCHED) -> DataFrame:
    return compute(notices, active_text=text_is_active(as_of, columns))


def active_notices(notices: DataFrame, as_of: date, columns: tuple[str, ...] = SEARCHED) -> DataFrame:
    """Active flag: closed status says no, structured dates decide, else text patterns or phase dates."""
    searched = match_active_text(notices, as_of, columns)
    return compute(searched, active=is_active(as_of, F.col("active_text")))


def is_active(as_of: date, in_text: Column) -> Column:
    """The flag of ``active_notices``; texts and phases are read only where neither status nor a structured date decides."""
    unset = F.lower(blank("prazo_inscricao")).isin("", "não informado", "nao informado")
    from_text = F.when(unset, F.array().cast("array<date>")).otherwise(D.token_dates("prazo_inscricao"))
    structured = F.array_max(F.array_append(from_text, D.loose_date("data_encerramento", names=False)))

    def phase_dates(f):
        parts = F.array(f["data_fim"], f["fim"], f["prazo"], f["data_inicio"], f["nome"])
        return F.flatten(F.transform(parts, lambda p: let(D.loose_date(p, names=False), lambda d: F.when(d.isNotNull(), F.array(d)).otherwise(D.token_dates(p)))))

    all_phase = F.flatten(F.transform(F.coalesce(D.phases("timeline_estimada"), F.array().cast(f"array<{_PHASE}>")), phase_dates))
    window = F.exists(all_phase, lambda d: D.in_active_window(d, as_of))
    open_ = let(structured, lambda d: F.when(d.isNotNull(), d >= F.lit(as_of)).otherwise(in_text | F.coalesce(window, F.lit(False))))
    return F.when(F.lower(F.trim(blank("status"))).isin("encerrado", "finalizado"), False).otherwise(open_)


_PHASE = "struct<nome: string, prazo: string, status: string, data_inicio: string, data_fim: string, fim: string>"
