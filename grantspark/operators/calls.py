"""Public calls published through hub pages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.html import ANCHOR, all_matches, block_text, element, part, text_of
from ..functions.text import WB_END, WB_START, grab, grab_all, has, head, none_if_blank, sub
from ..functions.urls import absolute_url, bare_host, decoded, path, query

# Words and patterns of call pages.
CALL_HINT = r"chamada|edital|editais|sele[cç][aã]o|participativo"
FILE_PATH = r"\.(pdf|docx?|xlsx?|zip)(\?|#|$)"
CONTENT_PATH = r"\/wps\/wcm\/connect\/"
DAY = r"(\d{1,2})[.\/](\d{1,2})[.\/](\d{4})"
PERIOD_WORD = (
    r"(?:abert[ao]s?|recebimento|inscri[çc][õo]es|envi(?:o|ad[ao]s?|ar)|encaminhad[ao]s?|submiss[ãa]o|prazo)"
)
NOT_PERIOD = r"d[úu]vida|esclarecimento|apresenta[çc][ãa]o|resultado"
AT_TIME = r"(?:(?:as|às)\s+\d{1,2}\s*h(?:\s*\d{2})?(?:min)?\s+(?:do\s+dia\s+)?)?"
PERIOD_RANGE = PERIOD_WORD + r"[^\n]{0,300}?(?:de|a\s+partir\s+de)\s+" + DAY + r"\s+(?:a|at[ée])\s+" + AT_TIME + DAY
PERIOD_UNTIL = PERIOD_WORD + r"[^\n]{0,300}?at[ée]\s+" + AT_TIME + DAY
LAUNCHED = r"(?:lan[çc]\w*,?\s+em|^em)\s+" + DAY
RELEVANT_FILE = r"edital|chamada|instru[çc]|regulamento|retifica"
SIDE_FILE = r"perguntas|faq|apresenta|folheto|folder|oficina"
CLOSED_HEAD = WB_START + r"resultado\s*(?::|final)"
CALL_HOST = "bndes.gov.br"
TITLE_HEAD = r"\sclass\s*=\s*[\"']tituloConteudoInterna[\"']"


def page_key(url):
    """Stable identity of a portal page: its content path if given, else its path."""
    inner = grab(query(url), r"[?&]urile=([^&]+)")
    return F.when(inner.isNotNull(), sub(F.lower(decoded(inner)), r"\/+$")).otherwise(sub(F.lower(path(url)), r"\/+$"))


def call_candidates(anchors: DataFrame, year: int, limit: int | None = None) -> DataFrame:
    """Distinct call pages linked from hub pages, old ones skipped; with ``limit`` the first so many in hub order."""
    rows = anchors.where(
        (bare_host("abs") == CALL_HOST)
        & ~has("href", r"^mailto:")
        & ~has(path("abs"), FILE_PATH)
        & ~has("abs", CONTENT_PATH)
        & has(F.concat_ws(" ", "text", decoded("abs")), CALL_HINT)
    )
    rows = rows.withColumn("key", page_key("abs")).where((F.col("key") != "") & (F.col("key") != page_key("url")))
    # the first link per page and key speaks for the hub; a hub whose link text is old adds nothing
    in_hub = rows.groupBy("page_id", "key").agg(F.min_by(F.struct("pos", "abs", "text"), "pos").alias("r")).select("page_id", "key", "r.*")
    years = grab_all("text", WB_START + r"(20\d{2})" + WB_END, 1).cast("array<int>")
    in_hub = in_hub.where(F.coalesce(F.array_max(years) >= year - 1, F.lit(True)))
    first = in_hub.groupBy("key").agg(F.min_by(F.struct("page_id", "pos", "abs", "text"), F.struct("page_id", "pos")).alias("r"))
    found = first.select("key", "r.*")
    return found if limit is None else found.orderBy("page_id", "pos").limit(limit)


def _iso(match, pattern, d, m, y):
    dd, mm = grab(match, pattern, d).cast("int"), grab(match, pattern, m).cast("int")
    text = F.concat_ws("-", grab(match, pattern, y), F.lpad(mm.cast("string"), 2, "0"), F.lpad(dd.cast("string"), 2, "0"))
    return F.when(dd.between(1, 31) & mm.between(1, 12), text)


def call_dates_of(text):
    """Struct of publication, closing and latest year of a call's block text."""
    keep = lambda m: ~has(m, NOT_PERIOD)
    ranges = F.filter(grab_all(text, PERIOD_RANGE), keep)
    untils = F.filter(grab_all(text, PERIOD_UNTIL), keep)
    starts = F.transform(ranges, lambda m: _iso(m, PERIOD_RANGE, 1, 2, 3))
    ends = F.concat(
        F.transform(ranges, lambda m: _iso(m, PERIOD_RANGE, 4, 5, 6)), F.transform(untils, lambda m: _iso(m, PERIOD_UNTIL, 1, 2, 3))
    )
    launch = grab(text, "(?m)" + LAUNCHED, 0)
    launched = F.when(launch.isNotNull(), _iso(launch, "(?m)" + LAUNCHED, 1, 2, 3))
    return F.struct(
        F.coalesce(launched, F.array_min(F.array_compact(starts))).alias("data_publicacao"),
        F.array_max(F.array_compact(ends)).alias("data_encerramento"),
        F.array_max(grab_all(text, DAY, 3).cast("array<int>")).alias("max_year"),
    )


def call_dates(texts: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    return texts.select(*keep, call_dates_of(F.col(column)).alias("d")).select(*keep, "d.*")


def file_score(text, url):
    s = F.concat_ws(" ", text, decoded(url))
    return F.when(has(s, RELEVANT_FILE), 2).when(has(s, SIDE_FILE), 1).otherwise(0)


def call_detail(pages: DataFrame, as_of: date, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Call pages (page_id, url, html) to notices, and their files by relevance."""
    p = pages.select("page_id", "url", "html", element("html", "h1", TITLE_HEAD).alias("h1"))
    p = p.withColumn("titulo", F.coalesce(none_if_blank(text_of("h1")), text_of(element("html", "title")))).where("titulo <> ''")
    p = p.withColumn("root", F.coalesce(element("html", "article"), element("html", "body")))
    p = p.withColumn("text", block_text("root"))
    paragraphs = F.transform(all_matches("root", r"<p(?:\s[^>]*)?>(.*?)<\/p\s*>", 1), text_of)
    p = p.withColumn("descricao", F.get(F.filter(paragraphs, lambda x: F.length(x) >= 80), F.lit(0)))
    p = p.withColumn("d", call_dates_of(F.col("text")))
    closed = (F.col("d.data_encerramento") < as_of.isoformat()) | has(head("text", 600), CLOSED_HEAD)
    notices = p.select(
        "page_id",
        "titulo", "descricao",
        F.lit("bndes").alias("fonte"), F.lit("BNDES").alias("orgao"), F.col("url").alias("link"),
        "d.data_publicacao", "d.data_encerramento", "d.max_year",
        F.when(F.coalesce(closed, F.lit(False)), "Encerrada").otherwise("Aberta").alias("status"),
    )
    links = p.select("page_id", "url", F.posexplode(all_matches("root", ANCHOR)).alias("pos", "m")).select(
        "page_id", "pos",
        absolute_url(part(F.col("m"), ANCHOR, 1), "url").alias("pdf_url"),
        text_of(part(F.col("m"), ANCHOR, 2)).alias("text"),
    )
    links = links.where(has(path("pdf_url"), r"\.pdf$")).withColumn("key", F.lower(path("pdf_url")))
    once = links.groupBy("page_id", "key").agg(F.min_by(F.struct("pos", "pdf_url", "text"), "pos").alias("r")).select("page_id", "r.*")
    once = once.withColumn("score", file_score("text", "pdf_url"))
    rank = F.row_number().over(W.partitionBy("page_id").orderBy(F.desc("score"), "pos"))
    files = once.withColumn("rn", rank).select("page_id", "pdf_url", "score", "rn")
    return notices, files if max_files is None else files.where(F.col("rn") <= max_files)


def filter_current_calls(notices: DataFrame, files: DataFrame, year: int) -> DataFrame:
    """Calls with files whose closing, else publication, else latest cited year is not past; one per title."""
    ref = F.coalesce(F.substring("data_encerramento", 1, 4).cast("int"), F.substring("data_publicacao", 1, 4).cast("int"), F.col("max_year"))
    rows = notices.where(ref >= year).join(files.select("page_id").distinct(), "page_id", "left_semi")
    first = rows.groupBy(F.lower("titulo").alias("title_key")).agg(F.min_by(F.struct(*notices.columns), "page_id").alias("r"))
    return first.select("r.*")
