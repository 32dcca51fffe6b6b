"""Queries of the notice normalization group (2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import notices as N
from . import duck as d
from .registry import query

T = d.T


@query("build_titles", "notices", f"SELECT id, {d.title('titulo', 'numero', 'fonte')} AS titulo_final FROM notices")
def build_titles(f):
    return N.build_titles(f.notices).select("id", "titulo_final")


@query("classify_titles", "notices", f"""SELECT k, text, {d.supp('text')} AS is_supplement, {d.weak('text')} AS is_weak FROM
 (SELECT CAST(id AS VARCHAR) AS k, titulo AS text FROM notices UNION ALL SELECT 'd'||CAST(doc_id AS VARCHAR), left(text, 60) FROM documents) t""")
def classify_titles(f):
    rows = f.notices.select(F.col("id").cast("string").alias("k"), F.col("titulo").alias("text"))
    rows = rows.unionByName(f.documents.select(F.concat(F.lit("d"), "doc_id").alias("k"), F.substring("text", 1, 60).alias("text")))
    return N.classify_titles(rows, "text")


_BLOCK = "CASE WHEN id % 2 = 0 THEN 'anexo ao Edital Nº '||CAST(id % 30 AS VARCHAR)||'/2024' ELSE '' END"
_HREF = "'https://x.br/chamada-tema-0'||CAST(id % 90 + 10 AS VARCHAR)||'-1998/det'"


@query("extract_notice_number", "notices", f"""
WITH b AS (SELECT id, titulo, {_BLOCK} AS block, {_HREF} AS href FROM notices)
SELECT id, {d.parent('titulo')} AS parent_number,
 coalesce(nullif({d.parent(d.link_text('titulo'))},''), nullif({d.parent('block')},''), CASE WHEN NOT {d.supp('titulo')} THEN {d.num(d.link_text('titulo'), *T.OWN_NUMBER)} END, '') AS link_number,
 {d.text_num('titulo')} AS text_number, coalesce({d.num('titulo', *T.TITLE_NUMBER)}, {d.text_num('titulo')}) AS title_number,
 regexp_extract(href, '([0-9]{{2,3}})-1998', 1)||'/1998' AS slug_number FROM b""")
def extract_notice_number(f):
    block = F.when(F.col("id") % 2 == 0, F.concat(F.lit("anexo ao Edital Nº "), F.col("id") % 30, F.lit("/2024"))).otherwise("")
    href = F.concat(F.lit("https://x.br/chamada-tema-0"), F.col("id") % 90 + 10, F.lit("-1998/det"))
    rows = f.notices.select("id", "titulo", block.alias("block"), href.alias("href"))
    return N.extract_notice_number(rows, "titulo", "block", "href").drop("titulo", "block", "href")


@query("pick_preferred_title", "notices", f"""
WITH c AS (SELECT fonte, id % 40 AS grp, id AS pos, {d.link_text('titulo')} AS t FROM notices)
SELECT fonte, grp, t AS titulo FROM (SELECT *, row_number() OVER (PARTITION BY fonte, grp ORDER BY {d.score('t')} DESC, length(t) DESC, pos) AS rn FROM c WHERE t <> '') x WHERE rn = 1""")
def pick_preferred_title(f):
    rows = f.notices.select("fonte", (F.col("id") % 40).alias("grp"), F.col("id").alias("pos"), "titulo")
    return N.pick_preferred_title(rows, ["fonte", "grp"])


@query("normalize_payload", "notices", f"""
WITH t AS (SELECT id, fonte, nullif(trim(coalesce(numero,'')),'') AS numero, {d.title('titulo', 'numero', 'fonte')} AS t FROM notices),
u AS (SELECT id, fonte, numero, CASE WHEN {d.supp('t')} OR {d.weak('t')} THEN 'Edital '||numero ELSE t END AS titulo FROM t)
SELECT * FROM u WHERE titulo IS NOT NULL""")
def normalize_payload(f):
    return N.normalize_payload(f.notices.select("id", "fonte", "numero", "titulo"))


def _dt(group: int) -> str:
    return f"regexp_extract(data_encerramento, '([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})', {group})"


@query("normalize_dates_iso", "notices", f"""
SELECT id, CASE WHEN regexp_matches(data_encerramento, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN left(data_encerramento, 10)
 WHEN {_dt(0)} <> '' THEN {_dt(3)}||'-'||lpad({_dt(2)},2,'0')||'-'||lpad({_dt(1)},2,'0') END AS data_encerramento FROM notices""")
def normalize_dates_iso(f):
    return N.normalize_dates_iso(f.notices.select("id", "data_encerramento"), "data_encerramento")


def _urls(f):
    """File addresses of every usual and odd form, one per document."""
    k = F.col("doc_id")
    kid = k.cast("string")
    url = (
        F.when(k % 7 == 0, F.concat(F.lit(" https://www.finep.gov.br/images/a%20"), kid, F.lit(".pdf?v=1 ")))
        .when(k % 7 == 1, F.concat(F.lit("https://x.br/pdfjs/web/viewer.php?file=https%3A%2F%2Fx.br%2Fd%2F"), kid, F.lit(".pdf&page=1")))
        .when(k % 7 == 2, F.concat(F.lit("http://10.10.10.206/wp-content/uploads/"), kid, F.lit(".pdf")))
        .when(k % 7 == 3, F.concat(F.lit("https://site.gov.br/"), kid, F.lit(".pdf/view?x=1")))
        .when(k % 7 == 4, F.concat(F.lit("http://172."), (k % 40).cast("string"), F.lit(".1.1/a/"), kid, F.lit(".PDF")))
        .when(k % 7 == 5, F.concat(F.lit("https://srv"), kid, F.lit(".local/x.pdf")))
        .otherwise(F.concat(F.lit("sem esquema "), kid))
    )
    return f.documents.select("doc_id", F.concat(F.lit("src "), k % 5, F.lit("/é")).alias("fonte"),
                              F.when(k % 4 != 0, F.concat(k % 99, F.lit("/2026"))).alias("numero"), url.alias("url"))


_K = "CAST(doc_id AS VARCHAR)"
_URLS = f"""u AS (SELECT doc_id, 'src '||CAST(doc_id % 5 AS VARCHAR)||'/é' AS fonte, CASE WHEN doc_id % 4 <> 0 THEN CAST(doc_id % 99 AS VARCHAR)||'/2026' END AS numero,
 CASE doc_id % 7 WHEN 0 THEN 'https://legacy.finep.gov.br/images/a '||{_K}||'.pdf?v=1' WHEN 1 THEN 'https://x.br/d/'||{_K}||'.pdf'
 WHEN 2 THEN 'https://www.fapepi.pi.gov.br/wp-content/uploads/'||{_K}||'.pdf' WHEN 3 THEN 'https://site.gov.br/'||{_K}||'.pdf'
 WHEN 4 THEN 'http://172.'||CAST(doc_id % 40 AS VARCHAR)||'.1.1/a/'||{_K}||'.PDF' WHEN 5 THEN 'https://srv'||{_K}||'.local/x.pdf' ELSE 'sem esquema '||{_K} END AS pdf_url FROM documents)"""


@query("resolve_pdf_urls", "", f"WITH {_URLS} SELECT doc_id, pdf_url FROM u")
def resolve_pdf_urls(f):
    return N.resolve_pdf_urls(_urls(f)).select("doc_id", "pdf_url")


@query("filter_unroutable", "", f"WITH {_URLS} SELECT doc_id, pdf_url FROM u WHERE doc_id % 7 < 4 OR (doc_id % 7 = 4 AND doc_id % 40 NOT BETWEEN 16 AND 31)")
def filter_unroutable(f):
    return N.filter_unroutable(N.resolve_pdf_urls(_urls(f))).select("doc_id", "pdf_url")


_SEG = "left(regexp_replace(regexp_replace(regexp_replace({0}, '[^a-zA-Z0-9._-]', '_', 'g'), '_{{2,}}', '_', 'g'), '^_+|_+$', '', 'g'), {1})"
_BASE = "regexp_extract(regexp_replace(pdf_url, '[?#].*$', ''), '([^/]+)$', 1)"
_FILE = f"CASE WHEN doc_id % 7 = 6 THEN 'edital.pdf' ELSE {_SEG.format(_BASE, 200)} END"
_PATHS = f"{_URLS}, sp AS (SELECT *, {_FILE} AS nome_arquivo, {_SEG.format('fonte', 100)}||'/'||{_SEG.format("coalesce(numero,'unknown')", 100)}||'/'||{_FILE} AS caminho_storage FROM u)"


@query("storage_paths", "", f"WITH {_PATHS} SELECT doc_id, nome_arquivo, caminho_storage FROM sp")
def storage_paths(f):
    return N.storage_paths(N.resolve_pdf_urls(_urls(f))).select("doc_id", "nome_arquivo", "caminho_storage")


@query("upsert_notices", "", """
WITH o AS (SELECT o_orderkey AS id, 'src'||CAST(o_custkey % 27 AS VARCHAR) AS fonte, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR)||'/98' END AS numero,
   'Edital '||CAST(o_orderkey % 3000 AS VARCHAR) AS titulo, 'velha' AS descricao, 'aberta' AS status, o_orderdate AS criado_em FROM orders WHERE o_orderkey % 3 <> 0),
n AS (SELECT o_orderkey AS pos, 'src'||CAST(o_custkey % 27 AS VARCHAR) AS fonte, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR)||'/98' END AS numero,
   'Edital '||CAST(o_orderkey % 3000 AS VARCHAR) AS titulo, CASE WHEN o_orderkey % 2 = 0 THEN 'nova '||CAST(o_orderkey AS VARCHAR) END AS descricao, CASE WHEN o_orderkey % 5 = 0 THEN 'fechada' END AS status FROM orders WHERE o_orderkey % 4 <> 0),
nn AS (SELECT numero, fonte, titulo, descricao, status FROM n WHERE numero IS NOT NULL),
nt AS (SELECT fonte, titulo, arg_max(descricao, pos) FILTER (WHERE descricao IS NOT NULL) AS descricao, arg_max(status, pos) FILTER (WHERE status IS NOT NULL) AS status FROM n WHERE numero IS NULL GROUP BY 1, 2),
a AS (SELECT o.id, coalesce(o.numero, nn.numero) AS numero, coalesce(o.fonte, nn.fonte) AS fonte, coalesce(nn.titulo, o.titulo) AS titulo, coalesce(nn.descricao, o.descricao) AS descricao,
   coalesce(nn.status, o.status) AS status, o.id IS NULL AS created, o.criado_em FROM o FULL OUTER JOIN nn ON o.numero = nn.numero AND o.fonte = nn.fonte),
r AS (SELECT *, row_number() OVER (PARTITION BY fonte, titulo ORDER BY coalesce(criado_em, TIMESTAMP '9999-12-31'), coalesce(id, 4611686018427387904), coalesce(numero,'')) AS rn FROM a)
SELECT id, numero, r.fonte, r.titulo, CASE WHEN rn = 1 THEN coalesce(nt.descricao, r.descricao) ELSE r.descricao END AS descricao,
  CASE WHEN rn = 1 THEN coalesce(nt.status, r.status) ELSE r.status END AS status, created FROM r LEFT JOIN nt ON r.fonte = nt.fonte AND r.titulo = nt.titulo
UNION ALL SELECT NULL, NULL, nt.fonte, nt.titulo, nt.descricao, nt.status, true FROM nt WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.fonte = nt.fonte AND a.titulo = nt.titulo)""")
def upsert_notices(f):
    k = F.col("o_orderkey")
    base = f.orders.select(
        k.alias("k"), F.concat(F.lit("src"), F.col("o_custkey") % 27).alias("fonte"), F.when(k % 7 != 0, F.concat(k, F.lit("/98"))).alias("numero"),
        F.concat(F.lit("Edital "), k % 3000).alias("titulo"), "o_orderdate",
    )
    old = base.where(F.col("k") % 3 != 0).select(
        F.col("k").alias("id"), "fonte", "numero", "titulo", F.lit("velha").alias("descricao"), F.lit("aberta").alias("status"), F.col("o_orderdate").alias("criado_em")
    )
    new = base.where(F.col("k") % 4 != 0).select(
        F.col("k").alias("pos"), "fonte", "numero", "titulo", F.when(F.col("k") % 2 == 0, F.concat(F.lit("nova "), "k")).alias("descricao"),
        F.when(F.col("k") % 5 == 0, "fechada").alias("status"),
    )
    return N.upsert_notices(old, new).select("id", "numero", "fonte", "titulo", "descricao", "status", "created")


@query("register_attachments", "", f"""WITH {_PATHS},
fr AS (SELECT *, doc_id % 50 AS edital_id, doc_id % 7 >= 5 OR (doc_id % 7 = 4 AND doc_id % 40 BETWEEN 16 AND 31) AS failed FROM sp WHERE caminho_storage NOT IN (SELECT caminho_storage FROM sp WHERE doc_id % 6 = 0)),
nw AS (SELECT caminho_storage, min(edital_id) AS edital_id FROM fr WHERE NOT failed GROUP BY 1)
SELECT coalesce(a.edital_id, b.edital_id) AS edital_id, coalesce(new_pdfs, 0) AS new_pdfs, coalesce(failed_pdfs, 0) AS failed_pdfs FROM (SELECT edital_id, count(*) AS new_pdfs FROM nw GROUP BY 1) a
FULL OUTER JOIN (SELECT edital_id, count(*) AS failed_pdfs FROM fr WHERE failed GROUP BY 1) b ON a.edital_id = b.edital_id""")
def register_attachments(f):
    found = _urls(f).select("doc_id", (F.col("doc_id") % 50).alias("edital_id"), "fonte", "numero", F.col("url").alias("pdf_url"))
    stored = N.storage_paths(N.resolve_pdf_urls(_urls(f).where("doc_id % 6 = 0")))
    return N.register_attachments(stored, found.drop("doc_id"))[1]


# names that differ only behind the cut: a first landing, then everything
_LONG = """l AS (SELECT doc_id, doc_id % 50 AS edital_id, CAST(doc_id % 10 AS VARCHAR)||'/2026' AS numero, repeat('parte-', 40)||CAST(doc_id AS VARCHAR)||'.pdf' AS name FROM documents),
p AS (SELECT *, 'src/'||replace(numero, '/', '_')||'/' AS folder, left(sha256('src/'||replace(numero, '/', '_')||'/'||name), 16) AS mark FROM l),
h AS (SELECT numero, coalesce(min(mark) FILTER (WHERE doc_id % 6 = 0), min(mark)) AS holder FROM p GROUP BY 1)"""


@query("register_attachments_long", "", f"""WITH {_LONG}
SELECT edital_id, mark AS path_mark, folder||left(name, 200)||CASE WHEN mark = holder THEN '' ELSE '-'||mark END||'.pdf' AS caminho_storage, doc_id % 6 = 0 AS first FROM p JOIN h USING (numero)""")
def register_attachments_long(f):
    found = f.documents.select(
        (F.col("doc_id") % 50).alias("edital_id"), F.lit("src").alias("fonte"), F.concat(F.col("doc_id") % 10, F.lit("/2026")).alias("numero"),
        F.concat(F.lit("https://x.br/d/" + "parte-" * 40), "doc_id", F.lit(".pdf")).alias("pdf_url"), (F.col("doc_id") % 6 == 0).alias("early"),
    )
    empty = f.spark.createDataFrame([], "caminho_storage string, path_mark string, url_original string")
    first = f.stored("landed", lambda: N.register_attachments(empty, found.where("early"))[0])
    second = N.register_attachments(first, found)[0]
    both = first.withColumn("first", F.lit(True)).unionByName(second.withColumn("first", F.lit(False)))
    return both.select("edital_id", "path_mark", "caminho_storage", "first")


@query("require_pdf_filter", "notices attachments", "SELECT id, fonte FROM notices WHERE id IN (SELECT edital_id FROM attachments)")
def require_pdf_filter(f):
    pdfs = f.attachments.select(F.col("edital_id").alias("id"))
    return N.require_pdf_filter(f.notices.select("id", "fonte"), pdfs, ["id"])


@query("require_pdf_filter_report", "notices attachments", "SELECT fonte, count(*) AS skipped FROM notices WHERE id NOT IN (SELECT edital_id FROM attachments) GROUP BY 1")
def require_pdf_filter_report(f):
    return N.skipped_without_pdf(f.notices.select("id", "fonte"), f.attachments.select(F.col("edital_id").alias("id")), ["id"])
