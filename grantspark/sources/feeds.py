"""JSON feeds of notices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import br_date, in_year, year_in
from ..functions.html import all_matches, ANCHOR, FRAME_SRC, part
from ..functions.text import blank, none_if_blank, squish, strip
from ..functions.titles import build_title, text_number
from ..functions.urls import absolute_url, is_pdf_link

API_SCHEMA = (
    "struct<data: array<struct<id: string, attributes: struct<id: string, nome: string, data_final_inscricoes: string,"
    " encerramento_das_inscricoes: string, inicio_inscricoes: string>, relationships: struct<incentivador:"
    " struct<data: struct<id: string>>>>>, included: array<struct<type: string, id: string, attributes:"
    " struct<nome: string, name: string>>>>"
)
POST_SCHEMA = "struct<date: string, link: string, title: struct<rendered: string>, content: struct<rendered: string>>"
# Link prefix and file pattern of the two feeds.
OPPORTUNITY_LINK = "https://prosas.com.br/editais/"
PAYLOAD_PDF = r'https:\/\/api\.site\.fapemig\.br\/wp-content\/uploads\/[^"\\s]+\.pdf'
POSTS_BASE = "https://www.fapern.rn.gov.br"


def scan_json_api(responses: DataFrame, year: int) -> DataFrame:
    """Opportunities of all response pages (page_no, body) with their sponsor; first page wins per id."""
    parsed = responses.select("page_no", F.from_json("body", API_SCHEMA).alias("r"))
    items = parsed.select("page_no", F.posexplode("r.data").alias("pos", "d")).select(
        "page_no",
        "pos",
        F.coalesce(none_if_blank("d.attributes.id"), none_if_blank("d.id")).alias("id"),
        squish("d.attributes.nome").alias("nome"),
        F.col("d.relationships.incentivador.data.id").alias("sponsor"),
        br_date(F.coalesce(none_if_blank("d.attributes.data_final_inscricoes"), F.col("d.attributes.encerramento_das_inscricoes"))).alias("data_encerramento"),
        br_date("d.attributes.inicio_inscricoes").alias("data_publicacao"),
    )
    # only the first row of an id counts, even when that row's title is too short
    first = (
        items.where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min_by(F.struct("page_no", "nome", "sponsor", "data_encerramento", "data_publicacao"), F.struct("page_no", "pos")).alias("r"))
        .select("id", "r.*")
        .where(F.length("nome") >= 8)
    )
    sponsors = (
        parsed.select("page_no", F.posexplode("r.included").alias("ipos", "i"))
        .where("i.type = 'incentivador'")
        .groupBy("page_no", F.col("i.id").alias("sponsor"))
        .agg(F.min_by(F.coalesce(none_if_blank("i.attributes.nome"), none_if_blank("i.attributes.name")), "ipos").alias("sponsor_name"))
    )
    rows = first.join(sponsors, ["page_no", "sponsor"], "left").select(
        "id",
        build_title("nome", text_number("nome"), F.lit("prosas")).alias("titulo"),
        none_if_blank(text_number("nome")).alias("numero"),
        F.concat(F.lit(OPPORTUNITY_LINK), "id").alias("link"),
        "data_encerramento",
        "data_publicacao",
        F.lit("prosas").alias("fonte"),
        F.coalesce("sponsor_name", F.lit("Prosas")).alias("orgao"),
    )
    return rows.where(in_year("data_encerramento", "data_publicacao", year))


def pdf_urls_in(html, base):
    """Distinct PDF addresses of a page's anchors and frames."""
    links = F.concat(
        F.transform(all_matches(html, ANCHOR), lambda m: part(m, ANCHOR, 1)),
        F.transform(all_matches(html, FRAME_SRC), lambda m: part(m, FRAME_SRC, 1)),
    )
    return F.array_distinct(F.filter(F.transform(links, lambda h: absolute_url(h, base)), is_pdf_link))


def scan_wp_posts(posts: DataFrame, pages: DataFrame, year: int) -> DataFrame:
    """Posts (post_id, body) of the year; PDFs from the post, else from the page it links to."""
    p = posts.select("post_id", F.from_json("body", POST_SCHEMA).alias("p")).select(
        "post_id",
        blank("p.date").alias("date"),
        F.coalesce(none_if_blank(strip(F.regexp_replace(blank("p.title.rendered"), "<[^>]*>", ""))), F.lit("Edital FAPERN")).alias("titulo"),
        F.coalesce(none_if_blank(strip("p.link")), F.lit(POSTS_BASE)).alias("link"),
        pdf_urls_in(F.col("p.content.rendered"), F.lit(POSTS_BASE)).alias("own"),
    )
    p = p.where(year_in("date").isNull() | (year_in("date") == year))
    linked = pages.where(F.col("url").startswith("http")).groupBy("url").agg(F.min_by("html", "page_id").alias("html"))
    linked = linked.select(F.col("url").alias("link"), pdf_urls_in(F.col("html"), F.lit(POSTS_BASE)).alias("from_page"))
    return p.join(linked, "link", "left").select(
        "post_id",
        "titulo",
        "link",
        F.lit("FAPERN").alias("orgao"),
        F.lit("fapern").alias("fonte"),
        none_if_blank("date").alias("data_publicacao"),
        F.when(F.size("own") > 0, F.col("own")).otherwise(F.coalesce("from_page", F.array().cast("array<string>"))).alias("pdf_urls"),
    )


def scan_payload_urls(payloads: DataFrame) -> DataFrame:
    """Distinct PDF addresses in each serialized page payload (page_id, payload)."""
    return payloads.select(
        "page_id", F.array_distinct(F.regexp_extract_all(blank("payload"), F.lit("(?i)" + PAYLOAD_PDF), F.lit(0))).alias("pdf_urls")
    )
