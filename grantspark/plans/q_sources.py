"""Queries of the scan and listing groups (2.1, 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls, listings, sections
from ..operators.source_rules import RULES
from ..sources import feeds
from ..sources.tables import SCHEMAS, scan_pages, scan_tables
from . import duck as d
from .derived import AS_OF
from .registry import query

YEAR = AS_OF.year


@query("scan_tables", "notices attachments catalogue", """
SELECT n.fonte AS fonte, count(DISTINCT n.id) AS notices, count(a.id) AS attachments, count(n.numero) - count(a.id) AS balance,
  CAST(0 AS BIGINT) AS profiles, (SELECT count(*) FROM catalogue c WHERE c.fonte = n.fonte) AS published
FROM notices n LEFT JOIN attachments a ON a.edital_id = n.id GROUP BY n.fonte""")
def q_scan_tables(f):
    """Per source, from stored snapshots read with their schemas; no stored notice has a profile column, so it reads as null."""
    paths = {name: f.stored(name).stored_at for name in ("notices", "attachments", "catalogue")}
    columns = {"notices": ("id", "fonte", "numero", "perfil_execucao"), "attachments": ("edital_id",), "catalogue": ("fonte",)}
    t = scan_tables(f.spark, paths, SCHEMAS, columns)
    # pre-aggregated per notice, so neither side explodes on a hot notice
    att = t["attachments"].groupBy("edital_id").agg(F.count("*").alias("att"))
    n = t["notices"].join(att, F.col("id") == F.col("edital_id"), "left")
    copies = F.coalesce("att", F.lit(1))
    per = n.groupBy("fonte").agg(
        F.count("*").alias("notices"),
        F.coalesce(F.sum("att"), F.lit(0)).alias("attachments"),
        (F.sum(F.when(F.col("numero").isNotNull(), copies).otherwise(0)) - F.coalesce(F.sum("att"), F.lit(0))).alias("balance"),
        F.count("perfil_execucao").alias("profiles"),
    )
    published = t["catalogue"].groupBy("fonte").agg(F.count("*").alias("published"))
    return per.join(published, "fonte", "left").withColumn("published", F.coalesce("published", F.lit(0)))


@query("scan_pages", "", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS chars FROM pages")
def q_scan_pages(f):
    return scan_pages(f.spark, f"{f.folder}/pages.parquet").select("page_id", "url", F.length("html").cast("long").alias("chars"))


# one response page per hundred orders: every order an opportunity, every customer class a sponsor
_API = """
items AS (SELECT o_orderkey AS k, CAST(floor(o_orderkey / 100) AS BIGINT) AS page_no, o_orderkey % 100 AS pos,
  CAST(o_orderkey % 12000 AS STRING) AS id,
  CASE WHEN o_orderkey % 9 = 0 THEN 'Curto' ELSE 'Prêmio  nº '||CAST(o_orderkey % 70 + 1 AS STRING)||'/'||CAST(year(o_orderdate) AS STRING)||' de inovação' END AS nome,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey % 6 AS STRING) END AS sponsor, o_orderdate AS dt FROM orders)
"""


@query("scan_json_api", "", "WITH " + _API.strip() + f""",
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page_no, pos) AS rn FROM items) t WHERE rn = 1 AND length(nome) >= 8)
SELECT id, regexp_replace(nome, ' +', ' ', 'g') AS titulo, regexp_extract(nome, 'nº ([0-9]+/[0-9]+)', 1) AS numero,
  'https://prosas.com.br/editais/'||id AS link, CASE WHEN k % 3 = 0 THEN NULL ELSE strftime(dt, '%d/%m/%Y') END AS data_encerramento,
  strftime(dt, '%d/%m/%Y') AS data_publicacao, 'prosas' AS fonte,
  CASE WHEN sponsor IN ('', '0') THEN 'Prosas' ELSE 'Instituto '||sponsor END AS orgao
FROM firsts WHERE year(dt) = {YEAR}""")
def scan_json_api(f):
    k = F.col("o_orderkey")
    item = F.struct(
        F.lit("oportunidade").alias("type"),
        (k % 12000).cast("string").alias("id"),
        F.struct(
            F.when(k % 9 == 0, "Curto").otherwise(
                F.concat(F.lit("Prêmio  nº "), k % 70 + 1, F.lit("/"), F.year("o_orderdate"), F.lit(" de inovação"))
            ).alias("nome"),
            F.when(k % 3 != 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z"))).alias("data_final_inscricoes"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("inicio_inscricoes"),
        ).alias("attributes"),
        F.struct(F.struct(F.struct(F.when(k % 5 != 0, (F.col("o_custkey") % 6).cast("string")).alias("id")).alias("data")).alias("incentivador")).alias("relationships"),
    )
    # a response page is bounded by the service's page size
    data = f.orders.withColumn("page_no", F.floor(k / 100)).groupBy("page_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((k % 100).alias("pos"), item.alias("i")))), lambda x: x["i"]).alias("data")
    )
    sponsors = F.array(*[
        F.struct(F.lit("incentivador").alias("type"), F.lit(str(i)).alias("id"),
                 F.struct(F.lit("" if i == 0 else f"Instituto {i}").alias("nome")).alias("attributes"))
        for i in range(6)
    ])
    return feeds.scan_json_api(data.select("page_no", F.to_json(F.struct("data", sponsors.alias("included"))).alias("body")), YEAR)


@query("scan_wp_posts", "details listings", f"""
, p AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE CAST(1996 + page_id % 3 AS VARCHAR)||'-03-0'||CAST(page_id % 9 + 1 AS VARCHAR)||'T10:00:00' END AS dt,
  url AS link FROM listings),
lp AS (SELECT url, arg_min(html, page_id) AS html FROM listings GROUP BY url),
a AS ({d.anchors("(SELECT page_id, 'https://www.fapern.rn.gov.br' AS url, html FROM listings)")})
SELECT p.page_id AS post_id, CASE WHEN page_id % 7 = 0 THEN 'Edital FAPERN' ELSE 'Edital de apoio '||CAST(page_id AS VARCHAR) END AS titulo, link,
  'FAPERN' AS orgao, 'fapern' AS fonte, nullif(dt, '') AS data_publicacao,
  CASE WHEN page_id % 2 = 0 THEN 'https://www.fapern.rn.gov.br/a.pdf;https://www.fapern.rn.gov.br/b.pdf'
    ELSE coalesce((SELECT string_agg(abs, ';' ORDER BY pos) FROM (SELECT page_id, abs, min(pos) AS pos FROM a GROUP BY 1,2) x WHERE x.page_id = p.page_id AND lower(abs) LIKE '%.pdf%'), '') END AS pdfs
FROM p WHERE dt = '' OR left(dt, 4) = '{YEAR}'""".replace(", p AS", "WITH p AS", 1))
def scan_wp_posts(f):
    pid = F.col("page_id")
    body = F.struct(
        F.when(pid % 5 == 0, "").otherwise(F.concat((1996 + pid % 3).cast("string"), F.lit("-03-0"), (pid % 9 + 1).cast("string"), F.lit("T10:00:00"))).alias("date"),
        F.col("url").alias("link"),
        F.struct(F.when(pid % 7 == 0, "<b></b>").otherwise(F.concat(F.lit(" Edital <i>de apoio</i> "), pid)).alias("rendered")).alias("title"),
        F.struct(F.when(pid % 2 == 0, '<a href="/a.pdf">A</a><iframe src="/b.pdf"></iframe><a href="/a.pdf">A</a>').otherwise("<p>sem</p>").alias("rendered")).alias("content"),
    )
    posts = f.listings.select(pid.alias("post_id"), F.to_json(body).alias("body"))
    out = feeds.scan_wp_posts(posts, f.listings, YEAR)
    return out.withColumn("pdfs", F.array_join("pdf_urls", ";")).drop("pdf_urls")


@query("scan_payload_urls", "", r"""
WITH p AS (SELECT page_id, '["https://api.site.fapemig.br/wp-content/uploads/2026/'||CAST(page_id AS VARCHAR)||'.pdf","https://api.site.fapemig.br/wp-content/uploads/2026/'||CAST(page_id AS VARCHAR)||'.pdf","https://api.site.fapemig.br/wp-content/uploads/outro/'||CAST(page_id % 3 AS VARCHAR)||'.PDF","https://x/y.pdf"]'||html AS payload FROM pages)
SELECT page_id, u AS pdf_url FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(payload, 'https://api\.site\.fapemig\.br/wp-content/uploads/[^"\\s]+\.pdf', 0, 'i')) AS u FROM p) t""")
def scan_payload_urls(f):
    base = "https://api.site.fapemig.br/wp-content/uploads/"
    pid = F.col("page_id").cast("string")
    own = F.concat(F.lit(f'"{base}2026/'), pid, F.lit('.pdf"'))
    payload = F.concat(F.lit("["), own, F.lit(","), own, F.lit(f',"{base}outro/'), (F.col("page_id") % 3).cast("string"),
                       F.lit('.PDF","https://x/y.pdf"]'), F.col("html"))
    found = feeds.scan_payload_urls(f.pages.select("page_id", payload.alias("payload")))
    return found.select("page_id", F.explode("pdf_urls").alias("pdf_url"))


@query("extract_anchors", "listings", f"SELECT page_id, CAST(pos AS BIGINT) AS pos, href, text, abs FROM ({d.anchors('listings')}) a")
def extract_anchors(f):
    return listings.extract_anchors(f.listings).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "text", "abs")


_PDF = f"lower(abs) LIKE '%.pdf%' AND NOT {d.has('abs', d.JUNK)}"


@query("extract_pdf_links", "listings", f"SELECT DISTINCT page_id, {d.resolved('abs')} AS pdf_url FROM ({d.anchors('listings')}) a WHERE {_PDF}")
def extract_pdf_links(f):
    return listings.extract_pdf_links(f.listings)


def _rule_sql() -> str:
    h = "lower(regexp_extract(abs, '^[a-z]+://([^/?#:]*)', 1))"
    p = "coalesce(nullif(regexp_extract(abs, '^[a-z]+://[^/?#]*([^?#]*)', 1), ''), '/')"
    arms = []
    for r in RULES:
        hint = d.has(p, r.path_hint)
        if r.text_hint:
            hint = f"({hint} OR ({d.has('text', r.text_hint)} AND length({p}) > {r.text_hint_path_chars}))"
        arm = f"fonte = {d.q(r.source)} AND {d.has(h, r.host)} AND {hint}"
        if r.require_path:
            arm += f" AND {d.has(p, r.require_path)}"
        if r.exclude_path:
            arm += f" AND NOT {d.has(p, r.exclude_path)}"
        if r.exclude_url:
            arm += f" AND NOT {d.has('abs', r.exclude_url)}"
        if r.min_text:
            arm += f" AND length(text) >= {r.min_text}"
        arms.append(f"({arm})")
    return " OR ".join(arms)


_IS_FILE = (
    "((lower(abs) LIKE '%.pdf%' AND (fonte <> 'facepe' OR abs LIKE '%facepe.br%')) OR (fonte = 'fapdf' AND lower(abs) LIKE '%/documents/%')"
    f" OR (fonte = 'faperj' AND lower(abs) LIKE '%rp/downloads%')) AND NOT {d.has('abs', d.JUNK)}"
)
_CLASSIFIED = f"c0 AS ({d.anchors('listings', 'fonte')}), c AS (SELECT *, {_IS_FILE} AS is_file, ({_rule_sql()}) AS rule FROM c0)"


@query("classify_notice_links", "listings", f"WITH {_CLASSIFIED} SELECT fonte, page_id, CAST(pos AS BIGINT) AS pos, abs, is_file, NOT is_file AND rule AS is_notice FROM c")
def classify_notice_links(f):
    c = listings.classify_notice_links(listings.extract_anchors(f.listings, "fonte"))
    return c.select("fonte", "page_id", F.col("pos").cast("long").alias("pos"), "abs", "is_file", "is_notice")


_ROWS = f"""{_CLASSIFIED},
r0 AS (SELECT *, {d.text_num('text')} AS n FROM c WHERE is_file OR rule),
r1 AS (SELECT *, {d.title('text', 'n', 'fonte')} AS titulo FROM r0),
r AS (SELECT fonte, page_id, pos, CASE WHEN is_file THEN coalesce(nullif(n,''), titulo) ELSE abs END AS chave, titulo,
  nullif(CASE WHEN is_file THEN n ELSE {d.text_num('titulo')} END, '') AS numero, CASE WHEN is_file THEN url ELSE abs END AS link,
  CASE WHEN is_file THEN {d.resolved('abs')} END AS pdf_url, NOT is_file AS needs_detail, page_id * 1000000 + pos AS ord FROM r1),
h AS (SELECT fonte, chave, arg_min(titulo, ord) FILTER (WHERE titulo <> '') AS titulo, arg_min(numero, ord) FILTER (WHERE numero <> '') AS numero,
  arg_min(link, ord) FILTER (WHERE link <> '') AS link, bool_or(needs_detail) AS needs_detail, min(ord) AS ord FROM r GROUP BY 1, 2),
pd AS (SELECT DISTINCT fonte, chave, pdf_url FROM r WHERE pdf_url IS NOT NULL)"""


def _merged(f):
    def rows():
        return listings.listing_rows(listings.classify_notice_links(listings.extract_anchors(f.listings, "fonte")))

    return listings.merge_listing_rows(f.stored("listing_rows", rows))


def _with_files(headers, pdfs):
    return headers.select("fonte", "chave", "titulo", "numero", "link").join(pdfs, ["fonte", "chave"], "left")


@query("merge_listing_rows", "listings", f"WITH {_ROWS} SELECT h.fonte, h.chave, titulo, numero, link, pdf_url FROM h LEFT JOIN pd ON h.fonte = pd.fonte AND h.chave = pd.chave")
def merge_listing_rows(f):
    return _with_files(*_merged(f))


_CUR, _CAND = d.link_text("titulo"), d.link_text("page_title")
_ENRICHED = f"""{_ROWS},
todo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fonte ORDER BY ord, chave) AS rn FROM h WHERE needs_detail) t),
pg AS (SELECT url AS plink, arg_min(html, page_id) AS html, min(page_id) AS page_id FROM details GROUP BY url),
pt AS (SELECT *, {d.text_of(d.element('html', 'h1'))} AS h1, {d.text_of(d.element('html', 'title'))} AS tt FROM pg),
f0 AS (SELECT todo.*, CASE WHEN length(h1) > 6 THEN h1 WHEN length(tt) > 6 AND NOT {d.has('tt', '404|erro')} THEN tt ELSE titulo END AS page_title
  FROM todo JOIN pt ON todo.link = pt.plink),
f1 AS (SELECT *, coalesce(numero, nullif({d.text_num('page_title')},''), nullif({d.text_num('titulo')},'')) AS n,
  CASE WHEN {_CUR} = '' THEN {_CAND} WHEN {_CAND} = '' THEN {_CUR} WHEN {d.score('page_title')} > {d.score('titulo')} THEN {_CAND}
   WHEN {d.score('page_title')} < {d.score('titulo')} THEN {_CUR} WHEN length({_CAND}) > length({_CUR}) THEN {_CAND} ELSE {_CUR} END AS better FROM f0),
f2 AS (SELECT *, {d.title('better', 'n', 'fonte')} AS nt FROM f1),
e AS (SELECT h.fonte, h.chave, coalesce(nt, h.titulo) AS titulo, coalesce(h.numero, nullif({d.text_num('nt')},'')) AS numero, h.link, h.ord
  FROM h LEFT JOIN f2 ON h.fonte = f2.fonte AND h.chave = f2.chave),
da AS ({d.anchors("(SELECT page_id, plink AS url, html FROM pg)")}),
ep AS (SELECT fonte, chave, pdf_url FROM pd UNION SELECT todo.fonte, todo.chave, {d.resolved('abs')} FROM todo JOIN da ON todo.link = da.url WHERE {_PDF})"""


@query("enrich_from_detail", "listings details", f"WITH {_ENRICHED} SELECT e.fonte, e.chave, titulo, numero, link, pdf_url FROM e LEFT JOIN ep ON e.fonte = ep.fonte AND e.chave = ep.chave")
def enrich_from_detail(f):
    return _with_files(*listings.enrich_from_detail(*_merged(f), f.details))


@query("finalize_listing", "listings details", f"""WITH {_ENRICHED}, z AS (SELECT fonte, chave, {d.title('titulo', 'numero', 'fonte')} AS titulo, numero, link FROM e)
SELECT * FROM z WHERE NOT {d.supp('titulo')} AND NOT {d.weak('titulo')}""")
def finalize_listing(f):
    headers, _ = listings.enrich_from_detail(*_merged(f), f.details)
    return listings.finalize_listing(headers, YEAR).select("fonte", "chave", "titulo", "numero", "link")


_BLK = r"<(li|tr|article|section|td|p)([\s>])"
_LINKNUM = f"coalesce(nullif({d.parent(d.link_text('text'))},''), nullif({d.parent('block_text')},''), CASE WHEN NOT {d.supp('text')} THEN {d.num(d.link_text('text'), *d.T.OWN_NUMBER)} END, '')"


@query("attach_supplements", "listings", f"""
WITH b0 AS (SELECT page_id, url, string_split(regexp_replace(html, {d.q(_BLK)}, chr(1)||'<\\1\\2', 'gi'), chr(1)) AS l FROM listings),
b1 AS (SELECT page_id, url, unnest(l) AS block, generate_subscripts(l,1) AS bpos FROM b0),
b2 AS (SELECT *, {d.text_of("regexp_replace(block, '</(li|tr|article|section|td|p)\\s*>.*$', '', 'si')")} AS block_text, regexp_extract_all(block, {d.q(d.ANCHOR)}, 0, 'si') AS ms FROM b1 WHERE lower(block) LIKE '%.pdf%'),
b3 AS (SELECT page_id, url, bpos, block_text, unnest(ms) AS m, generate_subscripts(ms,1) AS apos FROM b2),
b4 AS (SELECT *, {d.text_of(f"regexp_extract(m, {d.q(d.ANCHOR)}, 2, 'si')")} AS text, {d.absurl(f"regexp_extract(m, {d.q(d.ANCHOR)}, 1, 'si')", 'url')} AS pdf_url FROM b3),
b5 AS (SELECT *, {_LINKNUM} AS numero, NOT {d.supp('text')} AS main, bpos * 10000 + apos AS ord FROM b4 WHERE lower(pdf_url) LIKE '%.pdf%' AND length(text) >= 4),
b6 AS (SELECT *, {d.title('text', 'numero', "'funcap'")} AS titulo, min(ord) OVER (PARTITION BY page_id, numero) AS st FROM b5 WHERE numero <> ''),
b7 AS (SELECT page_id, numero, titulo, row_number() OVER (PARTITION BY page_id, numero ORDER BY {d.score('titulo')} DESC, length({d.link_text('titulo')}) DESC, ord) AS rn FROM b6 WHERE main OR ord = st)
SELECT b7.page_id, b7.numero, {d.title('b7.titulo', 'b7.numero', "'funcap'")} AS titulo, x.pdf_url FROM b7
JOIN (SELECT DISTINCT page_id, numero, pdf_url FROM b6) x ON b7.page_id = x.page_id AND b7.numero = x.numero WHERE rn = 1""")
def attach_supplements(f):
    headers, files = sections.attach_supplements(sections.block_anchors(f.listings), "funcap")
    return headers.join(files, ["page_id", "numero"])


def _reg_date(x: str) -> str:
    named = r"(\d{1,2})\s+de\s+(junho|julho|maio)[^\d]*(\d{4})"
    g = lambda i: f"regexp_extract({x}, {d.q(named)}, {i}, 'i')"
    return (
        f"CASE WHEN regexp_matches({x}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN regexp_extract({x}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') WHEN regexp_matches({x}, {d.q(named)}, 'i')"
        f" THEN lpad({g(1)},2,'0')||'/'||CASE lower({g(2)}) WHEN 'maio' THEN '05' WHEN 'julho' THEN '07' ELSE '06' END||'/'||{g(3)} END"
    )


@query("split_sections", "listings", f"""
WITH s0 AS (SELECT page_id, url, regexp_split_to_array(html, '(?i)<h[234][^>]*>') AS l FROM listings),
s1 AS (SELECT page_id, url, unnest(l) AS chunk, generate_subscripts(l,1)-1 AS section FROM s0),
s2 AS (SELECT *, {d.text_of("CASE WHEN instr(chunk,'</h') > 0 THEN left(chunk, instr(chunk,'</h')-1) ELSE left(chunk, length(chunk)-1) END")} AS titulo,
  CASE WHEN instr(chunk,'</h') > 0 THEN substring(chunk, instr(chunk,'</h')) ELSE right(chunk, 1) END AS body FROM s1 WHERE section > 0),
s3 AS (SELECT *, {d.grab('body', 'Inscri[çc][õo]es\\s+at[ée]:?\\s*([^<]+)')} AS until FROM s2 WHERE length(titulo) >= 8),
s4 AS (SELECT page_id, section, url, unnest(regexp_extract_all(body, {d.q(d.ANCHOR)}, 1, 'si')) AS href FROM s3),
s5 AS (SELECT DISTINCT page_id, section, {d.resolved('abs')} AS pdf_url FROM (SELECT page_id, section, {d.absurl('href', 'url')} AS abs FROM s4) t WHERE {_PDF})
SELECT s3.page_id, CAST(s3.section AS BIGINT) AS section, titulo, {_reg_date('until')} AS data_encerramento, url AS link, pdf_url
FROM s3 LEFT JOIN s5 ON s3.page_id = s5.page_id AND s3.section = s5.section""")
def split_sections(f):
    rows, files = sections.split_sections(f.listings)
    return rows.join(files, ["page_id", "section"], "left").withColumn("section", F.col("section").cast("long"))


@query("split_sections_tree", "listings", """
SELECT page_id, 'Prêmio '||CAST(page_id AS VARCHAR) AS titulo, url AS link, regexp_extract(url, '^([a-z]+://[^/]*)', 1)||'/c/'||CAST(page_id AS VARCHAR)||'.pdf' AS pdf_url
FROM listings WHERE contains(html, '#collapse-')""")
def split_sections_tree(f):
    return sections.collapse_sections(f.listings)


@query("extract_registration_period", "listings", f"""
WITH t0 AS (SELECT page_id, {d.text_of('html')} AS text FROM listings),
t1 AS (SELECT *, regexp_extract_all(text, 'Inscrições:\\s*(\\d{{2}}/\\d{{2}}/\\d{{4}})\\s*a\\s*(\\d{{2}}/\\d{{2}}/\\d{{4}})', 0, 'i') AS ms,
  coalesce({d.grab('text', 'Inscri[çc][õo]es\\s+at[ée]:?\\s*([^<\\n]+)')}, text) AS u0 FROM t0),
t2 AS (SELECT page_id, text, coalesce({d.grab('text', 'Inscrições\\s+até:\\s*(\\d{2}/\\d{2}/\\d{4})')}, {_reg_date('u0')}) AS until, unnest(CASE WHEN len(ms) = 0 THEN [NULL] ELSE ms END) AS m,
  unnest(range(0, greatest(len(ms), 1))) AS rno, len(ms) AS nm FROM t1)
SELECT page_id, CASE WHEN nm = 0 THEN NULL ELSE rno END AS range_no, {d.grab('m', 'Inscrições:\\s*(\\d{2}/\\d{2}/\\d{4})')} AS data_inicio,
  coalesce({d.grab('m', 'a\\s*(\\d{2}/\\d{2}/\\d{4})$')}, until) AS data_encerramento, {d.grab('text', 'Vigência:\\s*(Encerrado|Aberto|Aberto\\.?)')} AS status FROM t2""")
def extract_registration_period(f):
    from ..functions.html import text_of

    texts = f.listings.select("page_id", text_of("html").alias("text"))
    out = sections.extract_registration_period(texts, "text", "page_id")
    return out.withColumn("range_no", F.col("range_no").cast("long"))


@query("extract_table_listing", "listings", f"""
WITH t0 AS (SELECT page_id, url, regexp_extract_all(html, '<tr[\\s>].*?</tr\\s*>', 0, 'si') AS l FROM listings),
t1 AS (SELECT page_id, url, unnest(l) AS r, generate_subscripts(l,1) AS pos FROM t0),
t2 AS (SELECT page_id, pos, {d.text_of(f"regexp_extract(r, {d.q(d.ANCHOR)}, 2, 'si')")} AS titulo, {d.absurl(f"regexp_extract(r, {d.q(d.ANCHOR)}, 1, 'si')", 'url')} AS link,
  regexp_extract_all(r, '<td(?:\\s[^>]*)?>(.*?)</td\\s*>', 1, 'si') AS cells FROM t1 WHERE regexp_matches(r, {d.q(d.ANCHOR)}, 'si')),
t3 AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM t2 WHERE titulo <> '' AND link LIKE '%/chamadapublica/%' AND NOT {d.has('titulo', '^\\+a$')} AND NOT {d.has('titulo', 'chamadas\\s+p[úu]blicas')})
SELECT link, titulo, nullif({d.text_of('cells[2]')},'') AS data_publicacao, nullif({d.text_of('cells[3]')},'') AS data_encerramento FROM t3 WHERE rn = 1""")
def extract_table_listing(f):
    return sections.extract_table_listing(f.listings)


@query("extract_table_listing_cards", "listings", f"""
WITH a AS ({d.anchors('listings')})
SELECT link, titulo FROM (SELECT abs AS link, text AS titulo, row_number() OVER (PARTITION BY abs ORDER BY page_id, pos) AS rn FROM a
WHERE regexp_matches(lower(abs), '^[a-z]+://[^/]*/([^?#]*/)?(chamadapublica/|(financiamento|credito|subvencao|patrocinio))') AND length(text) BETWEEN 6 AND 200
 AND NOT {d.has('text', '^(institucional|oportunidades|explore|busque|financiamento|cr[ée]dito|subven|patroc|contato|acesso)')} AND NOT {d.has('text', '^\\+a$|ver mais|saiba mais')}) t WHERE rn = 1""")
def extract_table_listing_cards(f):
    return sections.extract_product_cards(listings.extract_anchors(f.listings))


_KEY = """regexp_replace(lower(CASE WHEN regexp_matches({0}, '[?&]urile=') THEN replace(regexp_extract({0}, '[?&]urile=([^&#]+)', 1), '%3A', ':')
 ELSE regexp_extract({0}, '^[a-z]+://[^/]*([^?#]*)', 1) END), '/+$', '')"""


@query("call_candidates", "hubs", f"""
WITH a AS ({d.anchors('hubs')}),
k AS (SELECT *, {_KEY.format('abs')} AS key, {_KEY.format('url')} AS hub_key FROM a WHERE regexp_matches(abs, '^https?://(www\\.)?bndes\\.gov\\.br', 'i')
 AND NOT regexp_matches(abs, '\\.(pdf|docx?|xlsx?|zip)(\\?|#|$)', 'i') AND abs NOT ILIKE '%/wps/wcm/connect/%' AND {d.has("text||' '||abs", calls.CALL_HINT)}),
f1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, key ORDER BY pos) AS rn FROM k WHERE key <> '' AND key <> hub_key) t
 WHERE rn = 1 AND coalesce(list_max(list_transform(regexp_extract_all(text, '(?:^|[^0-9A-Za-z_])(20\\d{{2}})(?:$|[^0-9A-Za-z_])', 1), lambda y: CAST(y AS INT))) >= {YEAR - 1}, true)),
f2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id, pos) AS r2 FROM f1) t WHERE r2 = 1)
SELECT key, page_id, CAST(pos AS BIGINT) AS pos, abs, text FROM f2""")
def call_candidates(f):
    out = calls.call_candidates(listings.extract_anchors(f.hubs), YEAR)
    return out.withColumn("pos", F.col("pos").cast("long"))


_DM = "(\\d{1,2})[./](\\d{1,2})[./](\\d{4})"


def _iso_sql(m: str, p: str, a: int, b: int, c: int) -> str:
    g = lambda i: f"regexp_extract({m}, {d.q(p)}, {i}, 'i')"
    return (
        f"CASE WHEN CAST({g(a)} AS INT) BETWEEN 1 AND 31 AND CAST({g(b)} AS INT) BETWEEN 1 AND 12 THEN {g(c)}||'-'||lpad({g(b)},2,'0')||'-'||lpad({g(a)},2,'0') END"
    )


_ROOT = f"coalesce({d.element('html', 'article')}, {d.element('html', 'body')})"


def _block_sql(root: str) -> str:
    x = d.without(root, "script", "style", "noscript")
    x = f"regexp_replace({x}, '<br\\s*/?>', chr(10), 'gi')"
    x = f"regexp_replace({x}, '</(p|li|div|h1|h2|h3|h4|h5|h6|tr)\\s*>', chr(10)||'</\\1>', 'gi')"
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {d.q(a)}, {d.q(b)})"
    return f"array_to_string(list_filter(list_transform(string_split({x}, chr(10)), lambda z: {d.norm('z')}), lambda z: z <> ''), chr(10))"


_NOT = d.has("m", calls.NOT_PERIOD)
_CALLTEXT = f"ct AS (SELECT page_id, url, html, {_ROOT} AS root, {_block_sql(_ROOT)} AS text FROM calls)"
_CALLDATES = f"""{_CALLTEXT},
rg AS (SELECT page_id, m FROM (SELECT page_id, unnest(regexp_extract_all(text, {d.q(calls.PERIOD_RANGE)}, 0, 'i')) AS m FROM ct) t WHERE NOT {_NOT}),
un AS (SELECT page_id, m FROM (SELECT page_id, unnest(regexp_extract_all(text, {d.q(calls.PERIOD_UNTIL)}, 0, 'i')) AS m FROM ct) t WHERE NOT {_NOT}),
st AS (SELECT page_id, min({_iso_sql('m', calls.PERIOD_RANGE, 1, 2, 3)}) AS s FROM rg GROUP BY 1),
en AS (SELECT page_id, max(x) AS x FROM (SELECT page_id, {_iso_sql('m', calls.PERIOD_RANGE, 4, 5, 6)} AS x FROM rg UNION ALL SELECT page_id, {_iso_sql('m', calls.PERIOD_UNTIL, 1, 2, 3)} FROM un) t GROUP BY 1),
la AS (SELECT page_id, regexp_extract(text, {d.q('(?m)' + calls.LAUNCHED)}, 0, 'i') AS m, list_max(list_transform(regexp_extract_all(text, {d.q(_DM)}, 3), lambda y: CAST(y AS INT))) AS max_year FROM ct),
cd AS (SELECT la.page_id, coalesce(CASE WHEN m <> '' THEN {_iso_sql('m', '(?m)' + calls.LAUNCHED, 1, 2, 3)} END, s) AS data_publicacao, x AS data_encerramento, max_year
 FROM la LEFT JOIN st ON la.page_id = st.page_id LEFT JOIN en ON la.page_id = en.page_id)"""


@query("call_dates", "calls", f"WITH {_CALLDATES} SELECT * FROM cd")
def call_dates(f):
    from ..functions.html import block_text, element

    texts = f.calls.select("page_id", block_text(F.coalesce(element("html", "article"), element("html", "body"))).alias("text"))
    return calls.call_dates(texts, "text", "page_id")


_CH1 = d.text_of("regexp_extract(html, '<h1[^>]*class\\s*=\\s*[\"'']tituloConteudoInterna[\"''][^>]*>(.*?)</h1\\s*>', 1, 'si')")
_CALLS = f"""{_CALLDATES},
cn AS (SELECT ct.page_id, {_CH1} AS titulo,
  list_filter(list_transform(regexp_extract_all(root, '<p(?:\\s[^>]*)?>(.*?)</p\\s*>', 1, 'si'), lambda p: {d.text_of('p')}), lambda p: length(p) >= 80)[1] AS descricao,
  url AS link, data_publicacao, data_encerramento, max_year,
  CASE WHEN coalesce(data_encerramento < '{AS_OF}', false) OR regexp_matches(left(text, 600), '(^|[^0-9A-Za-z_])resultado\\s*(?::|final)', 'i') THEN 'Encerrada' ELSE 'Aberta' END AS status
  FROM ct JOIN cd ON ct.page_id = cd.page_id),
ca AS ({d.anchors('(SELECT page_id, url, root AS html FROM ct)')}),
cf AS (SELECT page_id, pos, abs AS pdf_url, text, row_number() OVER (PARTITION BY page_id, lower(regexp_extract(abs, '^[a-z]+://[^/]*([^?#]*)', 1)) ORDER BY pos) AS k
  FROM ca WHERE regexp_matches(regexp_extract(abs, '^[a-z]+://[^/]*([^?#]*)', 1), '\\.pdf$', 'i')),
cs AS (SELECT *, CASE WHEN {d.has("text||' '||pdf_url", calls.RELEVANT_FILE)} THEN 2 WHEN {d.has("text||' '||pdf_url", calls.SIDE_FILE)} THEN 1 ELSE 0 END AS score FROM cf WHERE k = 1),
cr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rn FROM cs) t)"""


@query("call_detail", "calls", f"WITH {_CALLS} SELECT cn.page_id, titulo, descricao, link, data_publicacao, data_encerramento, status, pdf_url, CAST(rn AS BIGINT) AS rn FROM cn LEFT JOIN cr ON cn.page_id = cr.page_id")
def call_detail(f):
    notices, files = calls.call_detail(f.calls, AS_OF)
    files = files.select("page_id", "pdf_url", F.col("rn").cast("long").alias("rn"))
    return notices.select("page_id", "titulo", "descricao", "link", "data_publicacao", "data_encerramento", "status").join(files, "page_id", "left")


@query("filter_current_calls", "calls", f"""WITH {_CALLS}
SELECT page_id, titulo, data_encerramento, status FROM (SELECT *, row_number() OVER (PARTITION BY lower(titulo) ORDER BY page_id) AS tk FROM cn
 WHERE coalesce(CAST(left(data_encerramento,4) AS INT), CAST(left(data_publicacao,4) AS INT), max_year) >= {YEAR} AND page_id IN (SELECT page_id FROM cr)) t WHERE tk = 1""")
def filter_current_calls(f):
    return calls.filter_current_calls(*calls.call_detail(f.calls, AS_OF), YEAR).select("page_id", "titulo", "data_encerramento", "status")


@query("filter_current_year", "notices", f"""
SELECT id, data_encerramento, data_publicacao FROM (SELECT *, coalesce(nullif(regexp_extract(data_encerramento, '(\\d{{4}})', 1),''), nullif(regexp_extract(data_publicacao, '(\\d{{4}})', 1),'')) AS y FROM notices) t
WHERE y IS NULL OR y = '{YEAR}'""")
def filter_current_year(f):
    return listings.filter_current_year(f.notices, "data_encerramento", "data_publicacao", YEAR).select("id", "data_encerramento", "data_publicacao")


@query("dedupe_first_wins", "", """
WITH k AS (SELECT doc_id, text AS key, source||'/'||CAST(doc_id % 300 AS VARCHAR)||'.pdf' AS pdf_url FROM documents),
g AS (SELECT key, min(doc_id) AS keep FROM k WHERE key <> '' GROUP BY key)
SELECT g.keep AS row_id, k.pdf_url FROM k JOIN g ON k.key = g.key GROUP BY 1, 2""")
def dedupe_first_wins(f):
    rows = f.documents.select(F.col("doc_id").alias("row_id"), F.col("text").alias("titulo"))
    files = f.documents.select(F.col("doc_id").alias("row_id"), F.concat("source", F.lit("/"), F.col("doc_id") % 300, F.lit(".pdf")).alias("pdf_url"))
    kept, donated = listings.dedupe_first_wins(rows, F.col("titulo"), ["row_id"], files)
    return kept.select("row_id").join(donated, "row_id")


@query("extract_main_text_dates", "details", f"""
WITH x AS (SELECT page_id, url, {d.without('html', 'script', 'style', 'noscript', 'iframe', 'nav', 'header', 'footer')} AS bare,
  regexp_extract_all({d.text_of(d.element('html', 'body'))}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') AS ds FROM details)
SELECT page_id, url, ds[1] AS data_publicacao, CASE WHEN len(list_distinct(ds)) > 1 THEN list_filter(ds, lambda v, i: list_position(ds, v) = i)[-1] ELSE ds[1] END AS data_encerramento,
  nullif({d.text_of(f"coalesce({d.element('bare', 'main')}, {d.element('bare', 'article')}, {d.element('bare', 'body')})")}, '') AS descricao FROM x""")
def extract_main_text_dates(f):
    return listings.extract_main_text_dates(f.details)


@query("mirror_source", "notices", """
SELECT id, fonte, orgao FROM notices UNION ALL SELECT id, 'sigfapes', coalesce(orgao, 'FAPES') FROM notices WHERE fonte = 'src5' AND NOT EXISTS (SELECT 1 FROM notices WHERE fonte = 'sigfapes')""")
def mirror_source(f):
    return listings.mirror_source(f.notices.select("id", "fonte", "orgao"), "sigfapes", "src5", "FAPES")


@query("summarize_scrape", "listings", f"""WITH {_ROWS}, pn AS (SELECT fonte, chave, count(*) AS links FROM pd GROUP BY 1, 2)
SELECT h.fonte, count(*) AS notices, CAST(coalesce(sum(links), 0) AS BIGINT) AS pdf_links, count(*) FILTER (WHERE links IS NULL) AS without_pdf,
 (SELECT count(DISTINCT pdf_url) FROM pd WHERE pd.fonte = h.fonte) AS pdf_unique FROM h LEFT JOIN pn ON h.fonte = pn.fonte AND h.chave = pn.chave GROUP BY h.fonte""")
def summarize_scrape(f):
    return listings.summarize_scrape(*_merged(f))
