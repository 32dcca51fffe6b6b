"""Notice normalization and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_text
from ..functions.frames import compute
from ..functions.text import blank, none_if_blank
from ..functions.titles import (
    build_title, is_supplement, is_weak, link_number, link_text, parent_number, slug_number, text_number, title_number, title_score,
)
from ..functions.urls import file_name, host, is_unroutable, resolve_pdf_url, storage_path, whole_path, with_mark

UPSERT_COLUMNS = ("titulo", "descricao", "data_publicacao", "data_encerramento", "status", "valor", "area", "orgao", "link", "processado_em")


def build_titles(rows: DataFrame, text: str = "titulo", number: str = "numero", source: str = "fonte") -> DataFrame:
    return compute(rows, titulo_final=build_title(text, number, source))


def classify_titles(rows: DataFrame, text: str = "titulo") -> DataFrame:
    return compute(rows, is_supplement=is_supplement(text), is_weak=is_weak(text))


def extract_notice_number(rows: DataFrame, text: str = "titulo", block: str | None = None, href: str | None = None) -> DataFrame:
    """Every reading of a notice number: parent, link, plain text, title and slug."""
    slug = {"slug_number": slug_number(href)} if href else {}
    return compute(
        rows, parent_number=parent_number(text), link_number=link_number(text, block), text_number=text_number(text),
        title_number=title_number(text), **slug,
    )


def pick_preferred_title(candidates: DataFrame, keys: Sequence[str], text: str = "titulo", order: str = "pos") -> DataFrame:
    """Best candidate per notice: score, then length, then the earliest."""
    c = compute(candidates, _t=link_text(text)).where("_t <> ''")
    rank = F.struct(title_score("_t"), F.length("_t"), -F.col(order))
    return c.groupBy(*keys).agg(F.max_by("_t", rank).alias("titulo"))


def normalize_payload(rows: DataFrame) -> DataFrame:
    """Final title of each row; rows with neither a usable title nor a number are dropped."""
    num = F.trim(blank("numero"))
    rows = rows.withColumn("numero", none_if_blank(num))
    rows = compute(rows, _t=build_title("titulo", "numero", "fonte"))
    bad = is_supplement("_t") | is_weak("_t") | (F.col("_t") == "")
    rows = rows.withColumn("titulo", F.when(bad, F.concat(F.lit("Edital "), F.col("numero"))).otherwise(F.col("_t")))
    return rows.where("titulo IS NOT NULL").drop("_t")


def normalize_dates_iso(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: iso_text(c) for c in columns})


def resolve_pdf_urls(rows: DataFrame, url: str = "url") -> DataFrame:
    return compute(rows, pdf_url=resolve_pdf_url(url))


def filter_unroutable(rows: DataFrame, url: str = "pdf_url", keep_rejected: bool = False) -> DataFrame:
    """Drop (or flag) addresses whose host is missing, private or local."""
    flagged = compute(rows, routable=~is_unroutable(F.coalesce(host(url), F.lit(""))))
    return flagged if keep_rejected else flagged.where("routable").drop("routable")


def storage_paths(rows: DataFrame, url: str = "pdf_url") -> DataFrame:
    return compute(rows, nome_arquivo=file_name(url), caminho_storage=storage_path("fonte", "numero", url))


def _last_non_null(columns: Sequence[str], order: str):
    """The newest non-blank value of each column: what repeated sparse writes leave behind."""
    out = []
    for c in columns:
        out.append(F.max_by(c, F.when(none_if_blank(F.col(c).cast("string")).isNotNull(), F.col(order))).alias(c))
    return out


def upsert_notices(stored: DataFrame, scraped: DataFrame, order: str = "pos", columns: Sequence[str] = UPSERT_COLUMNS) -> DataFrame:
    """Next snapshot of the notices.

    Numbered rows meet on (numero, fonte); unnumbered ones update the oldest stored row with the same
    (fonte, titulo), numbered or not. Several scraped rows with one key act in order, so per column the
    last non-null value wins; nulls never overwrite. ``created`` marks new rows.
    """
    new = scraped.withColumn("numero", none_if_blank(F.trim(blank("numero"))))
    cols = [c for c in columns if c in scraped.columns]
    stored = stored.withColumn("numero", none_if_blank("numero"))
    numbered = new.where("numero IS NOT NULL").groupBy("numero", "fonte").agg(*_last_non_null(cols, order))
    by_title = new.where("numero IS NULL").groupBy("fonte", F.col("titulo").alias("k_titulo")).agg(
        *_last_non_null([c for c in cols if c != "titulo"], order)
    )
    after_numbers = (
        stored.alias("o")
        .join(numbered.alias("n"), ["numero", "fonte"], "full_outer")
        .select(
            "o.id", "numero", "fonte",
            *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in cols],
            *[F.col(f"o.{c}") for c in stored.columns if c not in {"id", "numero", "fonte", *cols}],
            F.col("o.id").isNull().alias("created"),
        )
    )
    age = F.struct(F.coalesce("criado_em", F.lit("9999-12-31").cast("timestamp")), F.coalesce("id", F.lit(2**62)), F.coalesce("numero", F.lit("")))
    oldest = after_numbers.groupBy("fonte", "titulo").agg(F.min_by(F.struct("id", "numero"), age).alias("t"))
    aimed = by_title.join(oldest.withColumnRenamed("titulo", "k_titulo"), ["fonte", "k_titulo"], "left")
    hits = aimed.where("t IS NOT NULL").select(
        F.col("t.id").alias("h_id"), F.col("t.numero").alias("h_numero"), F.col("fonte").alias("h_fonte"),
        *[F.col(c).alias(f"h_{c}") for c in cols if c != "titulo"],
    )
    same = F.col("id").eqNullSafe(F.col("h_id")) & F.col("numero").eqNullSafe(F.col("h_numero")) & (F.col("fonte") == F.col("h_fonte"))
    updated = after_numbers.join(hits, same, "left").select(
        *[
            F.coalesce(f"h_{c}", c).alias(c) if c in cols and c != "titulo" else F.col(c)
            for c in after_numbers.columns
        ]
    )
    fresh = aimed.where("t IS NULL").withColumn("titulo", F.col("k_titulo")).withColumn("created", F.lit(True))
    return updated.unionByName(fresh.drop("k_titulo", "t"), allowMissingColumns=True)


def settle_paths(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Paths of files whose cut segments meet told apart; adds ``path_mark``, set where cutting lost something.

    Files that differ only behind the cut form a class. One of them holds the plain path: the one that is stored with it,
    else one that lost nothing, else the one with the least mark. The others carry their mark, sixteen hex digits of
    the uncut path, in the file name, so a file keeps its path whatever arrives later. ``stored`` may lack ``path_mark``
    (older rows): then the address (``url_original``, where there is one) tells who holds the path. Failed rows hold nothing.
    """
    rows = compute(rows, _whole=whole_path("fonte", "numero", "pdf_url"))
    rows = rows.withColumns({"_cut": F.col("_whole") != F.col("caminho_storage"), "_mark": F.left(F.sha2(F.col("_whole").cast("binary"), 256), F.lit(16))}).drop("_whole")
    none = F.lit(None).cast("string")
    held = stored.select(
        "caminho_storage", *[(F.col(c) if c in stored.columns else none).alias(to) for c, to in (("path_mark", "mark"), ("url_original", "url"))]
    )
    # only classes in which something was cut are looked into
    classes = rows.where("_cut").select("caminho_storage").union(held.where("mark IS NOT NULL").select("caminho_storage")).distinct()
    claims = held.select("caminho_storage", F.struct(F.lit(0).alias("turn"), F.lit(False).alias("cut"), "mark", "url").alias("claim")).union(
        rows.where("NOT failed").select("caminho_storage", F.struct(F.lit(1).alias("turn"), F.col("_cut").alias("cut"), F.col("_mark").alias("mark"), none.alias("url")).alias("claim"))
    )
    holders = claims.join(classes, "caminho_storage", "left_semi").groupBy("caminho_storage").agg(F.min("claim").alias("_h"))
    rows = rows.join(holders, "caminho_storage", "left")
    same_file = F.when(F.col("_h.mark").isNull(), F.coalesce(F.col("_h.url") == F.col("pdf_url"), ~F.col("_cut"))).otherwise(F.col("_h.mark") == F.col("_mark"))
    plain = F.col("_h").isNull() | same_file
    return rows.withColumns({
        "nome_arquivo": F.when(plain, F.col("nome_arquivo")).otherwise(with_mark(F.col("nome_arquivo"), F.col("_mark"))),
        "caminho_storage": F.when(plain, F.col("caminho_storage")).otherwise(with_mark(F.col("caminho_storage"), F.col("_mark"))),
        "path_mark": F.when(F.col("_cut") | ~plain, F.col("_mark")),
    }).drop("_h", "_cut", "_mark")


def register_attachments(stored: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New attachment rows by storage path, and per notice how many files are new or failed.

    ``found``: edital_id, fonte, numero, pdf_url, optional failed. A path shared by several rows is
    registered once; unroutable or failed downloads are counted, never fatal. Long names that are equal
    up to the cut are files of their own (``settle_paths``).
    """
    rows = storage_paths(filter_unroutable(resolve_pdf_urls(found, "pdf_url"), keep_rejected=True))
    download_failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in found.columns else F.lit(False)
    rows = settle_paths(rows.withColumn("failed", ~F.col("routable") | download_failed), stored)
    fresh = rows.join(stored.select("caminho_storage").distinct(), "caminho_storage", "left_anti")
    good = fresh.where("NOT failed").groupBy("caminho_storage").agg(
        F.min_by(F.struct("edital_id", "nome_arquivo", "pdf_url", "path_mark"), F.struct("edital_id", "pdf_url")).alias("r")
    )
    new = good.select(
        "r.edital_id", "r.nome_arquivo", "caminho_storage", F.col("r.pdf_url").alias("url_original"),
        F.lit("application/pdf").alias("tipo_mime"), F.lit(False).alias("is_processed"), "r.path_mark",
    )
    failed = fresh.where("failed").groupBy("edital_id").agg(F.count("*").alias("failed_pdfs"))
    added = new.groupBy("edital_id").agg(F.count("*").alias("new_pdfs"))
    counts = added.join(failed, "edital_id", "full_outer").na.fill(0, ["new_pdfs", "failed_pdfs"])
    return new, counts


def require_pdf_filter(notices: DataFrame, pdfs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only notices that have files."""
    return notices.join(pdfs.select(*keys).distinct(), list(keys), "left_semi")


def skipped_without_pdf(notices: DataFrame, pdfs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many notices per source the file requirement drops."""
    return notices.join(pdfs.select(*keys).distinct(), list(keys), "left_anti").groupBy("fonte").agg(F.count("*").alias("skipped"))
