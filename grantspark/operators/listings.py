"""Listing and detail pages to notice rows.

A notice's files are kept as distinct long rows (``fonte, chave, pdf_url``) beside one header row per
notice, so that no group of links is ever gathered into one array or one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import in_year
from ..functions.frames import compute
from ..functions.html import ANCHOR, all_matches, element, part, text_of, unescape, without
from ..functions.text import blank, grab_all, has, none_if_blank
from ..functions.titles import build_title, is_supplement, is_weak, preferred_title, text_number
from ..functions.urls import absolute_url, is_junk_pdf, is_pdf_link, resolve_pdf_url
from .source_rules import is_file_link, is_notice_link


def extract_anchors(pages: DataFrame, *keep: str) -> DataFrame:
    """Every usable anchor of each page, in page order."""
    parsed = F.transform(
        all_matches("html", ANCHOR),
        lambda m: F.struct(
            F.trim(unescape(part(m, ANCHOR, 1))).alias("href"),
            text_of(part(m, ANCHOR, 2)).alias("text"),
            absolute_url(unescape(part(m, ANCHOR, 1)), F.col("url")).alias("abs"),
        ),
    )
    found = pages.select("page_id", "url", *keep, F.posexplode(parsed).alias("pos", "a"))
    return found.select("page_id", "url", *keep, "pos", "a.href", "a.text", "a.abs").where("abs <> ''")


def extract_pdf_links(pages: DataFrame) -> DataFrame:
    """Distinct effective PDF addresses per page, institutional files left out."""
    links = extract_anchors(pages).where(is_pdf_link("abs") & ~is_junk_pdf("abs"))
    return links.select("page_id", resolve_pdf_url("abs").alias("pdf_url")).distinct()


def classify_notice_links(anchors: DataFrame) -> DataFrame:
    """Anchors (with ``fonte``) flagged as file link or notice link by their source's rule."""
    src, url, text = F.col("fonte"), F.col("abs"), F.col("text")
    is_file = is_file_link(src, url) & ~is_junk_pdf(url)
    flagged = compute(anchors, is_file=is_file, by_rule=is_notice_link(src, url, text))
    return flagged.withColumn("is_notice", F.expr("NOT is_file AND by_rule")).drop("by_rule")


def listing_rows(classified: DataFrame) -> DataFrame:
    """One candidate row per file or notice link, with the key that links of one notice share."""
    rows = compute(classified.where("is_file OR is_notice"), n=text_number("text"))
    rows = compute(rows, titulo=build_title("text", "n", "fonte"))
    return rows.select(
        "fonte", "page_id", "pos",
        F.when(F.col("is_file"), F.coalesce(none_if_blank("n"), F.col("titulo"))).otherwise(F.col("abs")).alias("chave"),
        "titulo",
        none_if_blank(F.when(F.col("is_file"), F.col("n")).otherwise(text_number("titulo"))).alias("numero"),
        F.when(F.col("is_file"), F.col("url")).otherwise(F.col("abs")).alias("link"),
        F.when(F.col("is_file"), resolve_pdf_url("abs")).alias("pdf_url"),
        F.col("is_notice").alias("needs_detail"),
    )


def merge_listing_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header per (source, key) with the first non-empty values, and its distinct files."""
    at = F.struct("page_id", "pos")

    def first(name: str):
        present = blank(name) != ""
        return F.min_by(F.when(present, F.col(name)), F.when(present, at)).alias(name)

    headers = rows.groupBy("fonte", "chave").agg(
        F.min(at).alias("at"), first("titulo"), first("numero"), first("link"), F.bool_or("needs_detail").alias("needs_detail")
    )
    headers = headers.select("fonte", "chave", "titulo", "numero", "link", "needs_detail", "at.page_id", "at.pos")
    return headers, rows.where("pdf_url IS NOT NULL").select("fonte", "chave", "pdf_url").distinct()


def detail_title(html, fallback):
    h1 = text_of(element(html, "h1"))
    title = text_of(element(html, "title"))
    return (
        F.when(F.length(h1) > 6, h1)
        .when((F.length(title) > 6) & ~has(title, "404|erro"), title)
        .otherwise(fallback)
    )


def enrich_from_detail(headers: DataFrame, pdfs: DataFrame, details: DataFrame, max_details: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Add title, number and files of each notice's own page; with ``max_details`` of each source's first pages only."""
    todo = headers.where("needs_detail")
    if max_details is not None:
        order = W.partitionBy("fonte").orderBy("page_id", "pos", "chave")
        todo = todo.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= max_details)
    todo = todo.select("fonte", "chave", "link", "titulo", "numero")
    # one copy of a page is enough, and a page several rows point to is parsed once
    wanted = details.join(todo.select(F.col("link").alias("url")).distinct(), "url", "left_semi")
    page = wanted.groupBy("url").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("p")).select("p.*", F.col("url").alias("link"))
    titles = compute(page, page_title=detail_title("html", F.lit(None).cast("string"))).select("link", "page_title")
    found = todo.join(titles, "link").withColumn("page_title", F.coalesce("page_title", "titulo"))
    found = compute(
        found,
        n=F.coalesce(F.col("numero"), none_if_blank(text_number("page_title")), none_if_blank(text_number("titulo"))),
        better=preferred_title(F.col("titulo"), F.col("page_title")),
    )
    found = compute(found, new_title=build_title("better", "n", "fonte")).select(
        "fonte", "chave", "new_title", F.coalesce("numero", none_if_blank(text_number("new_title"))).alias("new_number")
    )
    out = headers.join(found, ["fonte", "chave"], "left").select(
        "fonte", "chave",
        F.coalesce("new_title", "titulo").alias("titulo"),
        F.coalesce("new_number", "numero").alias("numero"),
        "link", "needs_detail", "page_id", "pos",
    )
    files = extract_pdf_links(page.select("page_id", F.col("link").alias("url"), "html"))
    by_link = page.select("page_id", "link").join(files, "page_id").select("link", "pdf_url")
    extra = todo.select("fonte", "chave", "link").join(by_link, "link").select("fonte", "chave", "pdf_url")
    return out, pdfs.unionByName(extra).distinct()


def finalize_listing(headers: DataFrame, year: int, closes: str | None = None, published: str | None = None) -> DataFrame:
    """Rebuild titles, drop supplements and weak titles, keep the current year."""
    h = compute(headers, titulo=build_title("titulo", "numero", "fonte"))
    h = h.where(~is_supplement("titulo") & ~is_weak("titulo"))
    if closes or published:
        null = F.lit(None).cast("string")
        h = filter_current_year(h, F.col(closes) if closes else null, F.col(published) if published else null, year)
    return h


def filter_current_year(notices: DataFrame, closes, published, year: int) -> DataFrame:
    """Rows closing (else published) in ``year``, and undated ones."""
    return notices.where(in_year(closes, published, year))


def dedupe_first_wins(rows: DataFrame, key, order: Sequence[str], files: DataFrame | None = None,
                      row_id: str = "row_id") -> DataFrame | tuple[DataFrame, DataFrame]:
    """First row of each non-empty key; with ``files`` (row_id, pdf_url) later rows donate theirs to it."""
    keyed = rows.withColumn("_key", key).where("_key <> ''")
    first = keyed.groupBy("_key").agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r"))
    kept = first.select("r.*")
    if files is None:
        return kept
    survivor = first.select("_key", F.col(f"r.{row_id}").alias("_survivor"))
    donated = keyed.select("_key", row_id).join(survivor, "_key").join(files, row_id)
    return kept, donated.select(F.col("_survivor").alias(row_id), "pdf_url").distinct()


def extract_main_text_dates(pages: DataFrame) -> DataFrame:
    """Cleaned main text and the first and last distinct date of each page."""
    whole = text_of(element("html", "body"))
    dates = F.array_distinct(grab_all(whole, r"\d{2}\/\d{2}\/\d{4}"))
    bare = without("html", "script", "style", "noscript", "iframe", "nav", "header", "footer")
    root = F.coalesce(element(bare, "main"), element(bare, "article"), element(bare, "body"))
    return pages.select(
        "page_id", "url", dates.alias("dates"), none_if_blank(text_of(root)).alias("descricao")
    ).select(
        "page_id", "url",
        F.try_element_at("dates", F.lit(1)).alias("data_publicacao"),
        F.try_element_at("dates", F.lit(-1)).alias("data_encerramento"),
        "descricao",
    )


def mirror_source(notices: DataFrame, source: str, mirrored: str, default_org: str) -> DataFrame:
    """If ``source`` has no rows, give it the rows of ``mirrored`` relabelled."""
    present = notices.where(F.col("fonte") == source).select(F.lit(mirrored).alias("fonte")).limit(1)
    relabelled = notices.where(F.col("fonte") == mirrored).join(F.broadcast(present), "fonte", "left_anti")
    relabelled = relabelled.withColumn("fonte", F.lit(source)).withColumn("orgao", F.coalesce(none_if_blank("orgao"), F.lit(default_org)))
    return notices.unionByName(relabelled)


def summarize_scrape(headers: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Per source: notices, file links, distinct files and notices without files."""
    per_notice = pdfs.groupBy("fonte", "chave").agg(F.count("*").alias("links"))
    # pre-counted per notice; distinct files counted from (source, file) pairs, so a hot source is spread
    counts = headers.join(per_notice, ["fonte", "chave"], "left").groupBy("fonte").agg(
        F.count("*").alias("notices"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("pdf_links"),
        F.count_if(F.col("links").isNull()).alias("without_pdf"),
    )
    unique = pdfs.select("fonte", "pdf_url").distinct().groupBy("fonte").agg(F.count("*").alias("pdf_unique"))
    return counts.join(unique, "fonte", "left").na.fill(0, ["pdf_unique"])
