"""Sections, tables, supplements and registration periods of listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.frames import compute
from ..functions.html import ANCHOR, all_matches, attribute, blocks, part, text_of, without
from ..functions.text import blank, grab, has, none_if_blank
from ..functions.titles import build_title, is_supplement, link_number, title_score, link_text
from ..functions.urls import absolute_url, is_junk_pdf, is_pdf_link, path, resolve_pdf_url
from ..session import materialize

# Headings and registration wording.
HEADING = r"<h[234][^>]*>"
# How the ids of collapse panels begin.
PANEL = "collapse-"
TAG = r"<(\/?)([a-z][^\s\/>]*)[^>]*>"
#: A link to a panel and its text, which ends at the end of the link or at the next one.
PANEL_LINK = rf"<a\s[^>]*?href\s*=\s*[\"']?\s*#({PANEL}[^\"'\s>]*)[^>]*>(.*?)(?=<\/a|<a[\s>]|$)"
# Month names the section dates use; any other month reads as June.
SECTION_MONTHS = {"maio": "05", "junho": "06", "julho": "07"}
REGISTRATION_UNTIL = r"Inscri[çc][õo]es\s+at[ée]:?\s*([^<\n]+)"
REGISTRATION_DATE = r"Inscrições\s+até:\s*(\d{2}\/\d{2}\/\d{4})"
VALIDITY = r"Vigência:\s*(Encerrado|Aberto|Aberto\.?)"
REGISTRATION_RANGE = r"Inscrições:\s*(\d{2}\/\d{2}\/\d{4})\s*a\s*(\d{2}\/\d{2}\/\d{4})"
# Link texts of portal navigation, never a call.
TITLE_BLOCK = r"^(institucional|oportunidades|explore|busque|financiamento|cr[ée]dito|subven|patroc|contato|acesso)"
NOT_A_TITLE = r"^\+a$"
LIST_TITLE = r"chamadas\s+p[úu]blicas"
MORE_LABEL = r"^\+a$|ver mais|saiba mais"
PRODUCT_PATH = r"\/(financiamento|credito|subvencao|patrocinio)"


def block_anchors(pages: DataFrame) -> DataFrame:
    """PDF anchors with the text of the block element they stand in."""
    cut = pages.select("page_id", "url", F.posexplode(blocks("html")).alias("bpos", "block"))
    inner = F.regexp_replace(F.col("block"), r"(?is)<\/(li|tr|article|section|td|p)\s*>.*$", "")
    cut = compute(cut.where(F.lower("block").contains(".pdf")), block_text=text_of(inner))
    parsed = F.transform(
        all_matches("block", ANCHOR),
        lambda m: F.struct(text_of(part(m, ANCHOR, 2)).alias("text"), absolute_url(part(m, ANCHOR, 1), F.col("url")).alias("pdf_url")),
    )
    found = cut.select("page_id", "url", "bpos", "block_text", F.posexplode(parsed).alias("apos", "a"))
    return found.select("page_id", "url", "bpos", "apos", "block_text", "a.text", "a.pdf_url").where(is_pdf_link("pdf_url") & (F.length("text") >= 4))


def attach_supplements(links: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Notices of a page grouped by number, addenda joining their parent; headers and distinct files.

    The number already looks at the link and its block, so an addendum without one has no parent and
    is dropped. The title is the best main-link title; among equals the earliest. A notice known only
    through supplements takes its number as title.
    """
    rows = compute(links, numero=link_number("text", "block_text"), main=~is_supplement("text")).where("numero <> ''")
    rows = compute(rows, titulo=build_title("text", "numero", F.lit(source)))
    place = F.struct("bpos", "apos")
    # the first row always proposes a title; later supplements do not
    keyed = rows.select("page_id", "numero", "bpos", "apos", "main", "titulo")
    start = keyed.groupBy("page_id", "numero").agg(F.min(place).alias("start"))
    cand = keyed.join(start, ["page_id", "numero"]).where(F.col("main") | (place == F.col("start")))
    rank = F.struct(title_score("titulo"), F.length(link_text("titulo")), -F.col("bpos"), -F.col("apos"))
    headers = cand.groupBy("page_id", "numero").agg(F.max_by("titulo", rank).alias("titulo"))
    headers = headers.withColumn("titulo", build_title("titulo", "numero", F.lit(source)))
    return headers, rows.select("page_id", "numero", "pdf_url").distinct()


def registration_date(text):
    """DD/MM/YYYY in the text, else day, month name and year."""
    exact = grab(text, r"(\d{2}\/\d{2}\/\d{4})")
    named = r"(\d{1,2})\s+de\s+(junho|julho|maio)[^\d]*(\d{4})"
    month = F.coalesce(*[F.when(F.lower(grab(text, named, 2)) == k, F.lit(v)) for k, v in SECTION_MONTHS.items()], F.lit("06"))
    return F.coalesce(exact, F.when(has(text, named), F.concat_ws("/", F.lpad(grab(text, named, 1), 2, "0"), month, grab(text, named, 3))))


def split_sections(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Heading-delimited sections: title and closing date, and the section's files."""
    parts = pages.select("page_id", "url", F.posexplode(F.split(blank("html"), "(?i)" + HEADING)).alias("section", "chunk"))
    parts = parts.where("section > 0").withColumn("cut", F.instr("chunk", "</h"))
    # a heading that is never closed has no usable end: its last character belongs to the body
    title = F.when(F.col("cut") > 0, F.expr("substring(chunk, 1, cut - 1)")).otherwise(F.expr("substring(chunk, 1, length(chunk) - 1)"))
    body = F.when(F.col("cut") > 0, F.expr("substring(chunk, cut)")).otherwise(F.expr("right(chunk, 1)"))
    parts = parts.select("page_id", "url", "section", text_of(title).alias("titulo"), body.alias("body"))
    parts = parts.where(F.length("titulo") >= 8)
    until = grab("body", r"Inscri[çc][õo]es\s+at[ée]:?\s*([^<]+)")
    rows = parts.select("page_id", "section", "titulo", registration_date(until).alias("data_encerramento"), F.col("url").alias("link"))
    files = parts.select("page_id", "section", "url", F.explode(all_matches("body", ANCHOR, 1)).alias("href"))
    files = files.select("page_id", "section", absolute_url("href", "url").alias("abs")).where(is_pdf_link("abs") & ~is_junk_pdf("abs"))
    return rows, files.select("page_id", "section", resolve_pdf_url("abs").alias("pdf_url")).distinct()


def panel_tokens(pages: DataFrame) -> DataFrame:
    """Tags of pages with collapse panels that open or close a panel's kind of element, and file links, in page order.

    Rows (page_id, url, doc, pos, tag, step, ident, href); ``step`` is +1, -1 or 0. Scripts, styles and comments hold no tags.
    """
    html = F.regexp_replace(without("html", "script", "style"), r"(?s)<!--.*?-->", "")
    p = pages.select("page_id", "url", "html").where(F.contains(F.lower(blank("html")), F.lit("#" + PANEL)))
    token = F.transform(
        all_matches(html, TAG),
        lambda t: F.struct(
            F.lower(part(t, TAG, 2)).alias("tag"),
            F.when(t.endswith("/>"), 0).when(part(t, TAG, 1) == "/", -1).otherwise(1).alias("step"),
            attribute(t, "id").alias("ident"),
            attribute(t, "href").alias("href"),
        ),
    )
    p = compute(p, doc=F.xxhash64("html"), tokens=token)
    panels = F.array_distinct(F.transform(F.filter("tokens", lambda t: t["ident"].startswith(PANEL)), lambda t: t["tag"]))
    p = compute(p.select("page_id", "url", "doc", "tokens"), panels=panels)
    rows = p.select("page_id", "url", "doc", "panels", F.posexplode("tokens").alias("pos", "t")).select("page_id", "url", "doc", "pos", "t.*", "panels")
    is_link = (F.col("tag") == "a") & (F.col("step") == 1) & is_pdf_link("href")
    return rows.where(is_link | F.array_contains("panels", F.col("tag"))).drop("panels")


def panel_ranges(tokens: DataFrame) -> DataFrame:
    """(page_id, doc, ident, start, end): where each panel's element opens and closes.

    The depth of an element among those of its own tag is a running sum in which a closing tag that closes nothing does not
    count; the element ends at the next tag that closes its depth, or with the page. A closing tag thus closes elements of
    its own tag only, also where it crosses others that were left open.
    """
    t = tokens.where("step <> 0").select("page_id", "doc", "tag", "pos", "step", "ident")
    # a page stored twice is one page here
    t = t.repartition("page_id", "doc", "tag").dropDuplicates(["page_id", "doc", "tag", "pos"])
    w = W.partitionBy("page_id", "doc", "tag").orderBy("pos")
    t = t.withColumn("sum", F.sum("step").over(w))
    t = t.withColumn("depth", F.col("sum") - F.least(F.lit(0), F.min("sum").over(w)))
    t = t.withColumn("before", F.coalesce(F.lag("depth").over(w), F.lit(0))).where("depth <> before")
    level = W.partitionBy("page_id", "doc", "tag", F.greatest("depth", "before")).orderBy("pos")
    t = t.withColumn("end", F.coalesce(F.lead("pos").over(level), F.lit(2**31 - 1)))
    return t.where((F.col("step") == 1) & F.col("ident").startswith(PANEL)).select("page_id", "doc", "ident", F.col("pos").alias("start"), "end")


def collapse_sections(pages: DataFrame, stretch: int = 64) -> DataFrame:
    """Collapse panels (tree form): panel title and its files, panels without files dropped.

    A panel's title is the text of the link to its id, its files are the links inside its element. Links and elements meet in
    stretches of ``stretch`` tags. Rows of one page number with other texts are pages of their own; a null page has no panels.
    """
    tokens = materialize(panel_tokens(pages), "panel-tokens")
    ranges = panel_ranges(tokens)
    links = tokens.where("step = 1 AND tag = 'a'").where(is_pdf_link("href")).select("page_id", "url", "doc", "pos", "href").withColumn("_at", F.floor(F.col("pos") / stretch))
    last = links.groupBy("page_id", "doc").agg(F.max("_at").alias("_last"))
    spread = ranges.join(last, ["page_id", "doc"])
    first = F.floor(F.col("start") / stretch)
    spread = spread.where(first <= F.col("_last")).select("page_id", "doc", "ident", "start", "end", F.explode(F.sequence(first, F.least("_last", F.floor(F.col("end") / stretch)))).alias("_at"))
    inside = spread.join(links, ["page_id", "doc", "_at"]).where("pos > start AND pos < end").select("page_id", "doc", "ident", "url", "href")

    heads = pages.select("page_id", F.xxhash64("html").alias("doc"), F.explode(all_matches("html", PANEL_LINK)).alias("m"))
    heads = compute(heads, ident=part(F.col("m"), PANEL_LINK, 1), titulo=F.trim(F.regexp_replace(text_of(part(F.col("m"), PANEL_LINK, 2)), r"[+\-]\s*$", "")))
    heads = heads.where("titulo <> ''").select("page_id", "doc", "ident", "titulo").distinct()
    found = inside.join(heads, ["page_id", "doc", "ident"])
    found = found.select("page_id", "titulo", F.col("url").alias("link"), absolute_url("href", "url").alias("pdf_url"))
    return found.where("pdf_url <> ''").distinct()


def extract_registration_period(texts: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    """Registration window of each text; a text with several ranges gives one row per range."""
    ranges = F.regexp_extract_all(blank(column), F.lit("(?iu)" + REGISTRATION_RANGE), F.lit(0))
    base = texts.select(
        *keep,
        F.coalesce(grab(column, REGISTRATION_DATE), registration_date(F.coalesce(grab(column, REGISTRATION_UNTIL), F.col(column)))).alias("until"),
        grab(column, VALIDITY).alias("status"),
        F.posexplode_outer(ranges).alias("range_no", "m"),
    )
    return base.select(
        *keep,
        "range_no",
        grab("m", REGISTRATION_RANGE, 1).alias("data_inicio"),
        F.coalesce(grab("m", REGISTRATION_RANGE, 2), F.col("until")).alias("data_encerramento"),
        "status",
    )


def extract_table_listing(pages: DataFrame) -> DataFrame:
    """Table rows with a detail link and two dates; one row per link, the first wins."""
    rows = pages.select("page_id", "url", F.posexplode(all_matches("html", r"<tr[\s>].*?<\/tr\s*>")).alias("pos", "row"))
    cells = all_matches("row", r"<td(?:\s[^>]*)?>(.*?)<\/td\s*>", 1)
    rows = rows.where(F.size(all_matches("row", ANCHOR)) > 0).select(
        "page_id", "pos",
        text_of(part(F.col("row"), ANCHOR, 2)).alias("titulo"),
        absolute_url(part(F.col("row"), ANCHOR, 1), "url").alias("link"),
        none_if_blank(text_of(F.get(cells, F.lit(1)))).alias("data_publicacao"),
        none_if_blank(text_of(F.get(cells, F.lit(2)))).alias("data_encerramento"),
    )
    rows = rows.where(
        (F.col("titulo") != "") & has(path("link"), r"\/chamadapublica\/") & ~has("titulo", NOT_A_TITLE) & ~has("titulo", LIST_TITLE)
    )
    return _first_per_link(rows, "titulo", "data_publicacao", "data_encerramento")


def extract_product_cards(anchors: DataFrame) -> DataFrame:
    """Card links of the newer portal, by path and title rules; one row per link."""
    p = F.lower(path("abs"))
    product = has(p, r"\/chamadapublica\/") | (has(p, PRODUCT_PATH) & ~p.endswith("/sobre-a-finep"))
    rows = anchors.where(product & F.length("text").between(6, 200) & ~has("text", TITLE_BLOCK) & ~has("text", MORE_LABEL))
    return _first_per_link(rows.select("page_id", "pos", F.col("text").alias("titulo"), F.col("abs").alias("link")), "titulo")


def _first_per_link(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy("link").agg(F.min_by(F.struct(*columns), F.struct("page_id", "pos")).alias("r")).select("link", "r.*")
