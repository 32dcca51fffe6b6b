"""Notice-like frames derived from the given tables by SQL that reads the same in Spark and DuckDB.

The given tables hold no funding notices, so notices, attachments, listing pages, model answers and
so on are derived row by row from them; every query's work therefore grows with the tables. The SQL
uses ``||`` (never ``concat``), no backslashes and no engine-specific function.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

AS_OF = date(1998, 8, 1)

_D = "lpad(CAST(day({0}) AS STRING),2,'0')"
_M = "lpad(CAST(month({0}) AS STRING),2,'0')"
_Y = "CAST(year({0}) AS STRING)"
DMY = f"{_D}||'/'||{_M}||'/'||{_Y}"
YMD = f"{_Y}||'-'||{_M}||'-'||{_D}"


def dmy(c: str) -> str:
    return DMY.replace("{0}", c)


def ymd(c: str) -> str:
    return YMD.replace("{0}", c)


def s(c: str) -> str:
    return f"CAST({c} AS STRING)"


K = "o_orderkey"
NOTICES = f"""
SELECT {K} AS id,
  'src'||{s('o_custkey % 27')} AS fonte,
  CASE WHEN {K} % 7 = 0 THEN NULL ELSE {s(f'{K} % 999 + 1')}||'/'||{s('year(o_orderdate)')} END AS numero,
  CASE WHEN {K} % 11 = 0 THEN 'ADENDO Nº 0'||{s(f'{K} % 9 + 1')} WHEN {K} % 13 = 0 THEN 'Saiba mais'
    WHEN {K} % 17 = 0 THEN '- Chamada pública nº '||{s(f'{K} % 90 + 1')}||' / '||{s('year(o_orderdate)')}||' do Edital nº '||{s(f'{K} % 50 + 1')}||'/'||{s('year(o_orderdate)')}
    ELSE 'Edital de fomento '||{s(f'{K} % 4000')} END AS titulo,
  CASE {K} % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Apoio a **projetos** de pesquisa' ELSE 'Chamada '||lower(o_orderpriority)||' com bolsa mensal para equipes de pesquisa e inovação' END AS descricao,
  CASE {K} % 3 WHEN 0 THEN NULL ELSE 'ORG'||{s('o_custkey % 5')} END AS orgao,
  CASE WHEN {K} % 8 = 0 THEN NULL ELSE lower(o_orderpriority) END AS area,
  CASE WHEN o_orderstatus = 'F' THEN 'Encerrado' ELSE 'aberta' END AS status,
  CASE {K} % 6 WHEN 0 THEN '' WHEN 1 THEN 'ftp://x' ELSE 'https://orgao'||{s('o_custkey % 5')}||'.gov.br/edital/'||{s(K)} END AS link,
  {ymd('o_orderdate')} AS data_publicacao,
  CASE {K} % 9 WHEN 0 THEN NULL WHEN 1 THEN 'em fluxo' WHEN 2 THEN 'até {{0}}' WHEN 3 THEN {ymd('o_orderdate')} ELSE {dmy('o_orderdate')} END AS data_encerramento,
  o_orderdate AS criado_em,
  CASE WHEN {K} % 10 < 7 THEN o_orderdate ELSE NULL END AS informacoes_processadas_em,
  CASE {K} % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Não informado'
    WHEN 2 THEN 'Até '||{dmy('o_orderdate')}
    WHEN 3 THEN 'de 01/01/'||{_Y.replace('{0}', 'o_orderdate')}||' a '||{dmy('o_orderdate')}
    WHEN 4 THEN {ymd('o_orderdate')}
    ELSE 'consulte o portal' END AS prazo_inscricao,
  CASE {K} % 5 WHEN 0 THEN NULL WHEN 1 THEN {s(f'{K} % 999 + 1')}||'/'||{s('year(o_orderdate)')}
    WHEN 2 THEN 'R$ '||{s('CAST(floor(o_totalprice) AS BIGINT) % 900 + 100')}||'.000,00 por projeto'
    WHEN 3 THEN 'valor global R$ '||{s('CAST(floor(o_totalprice) AS BIGINT) % 90 + 10')}||' milhões'
    ELSE 'bolsa R$ '||{s('CAST(floor(o_totalprice) AS BIGINT) % 9 + 1')}||'.'||lpad({s(f'{K} % 1000')},3,'0')||',00/mês' END AS valor_projeto,
  CASE WHEN {K} % 19 = 0 THEN 'R$ 1.500,00 por mês' ELSE NULL END AS valor_bolsa,
  CASE {K} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'N/A' ELSE 'Estado '||{s('o_custkey % 27')} END AS localizacao,
  CASE {K} % 7 WHEN 0 THEN NULL WHEN 1 THEN 'null' ELSE {s(f'{K} % 40')}||' vagas' END AS vagas,
  CASE {K} % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS is_researcher,
  CASE {K} % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS is_company,
  CASE {K} % 4 WHEN 0 THEN NULL WHEN 1 THEN 'curto' ELSE 'Programa de apoio à pesquisa aplicada com bolsas mensais de R$ 2.000,00 e prazo até '||{dmy('o_orderdate')} END AS sobre_programa,
  CASE {K} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'não especificado' ELSE 'Instituições sem fins lucrativos com sede no país e experiência comprovada na área' END AS criterios_elegibilidade,
  CASE {K} % 4 WHEN 0 THEN NULL
    WHEN 1 THEN '{{{{"fases":[]}}}}'
    WHEN 2 THEN '{{{{"fases":[{{{{"nome":"Lançamento","prazo":"","status":"","data_inicio":"01/01/'||{_Y.replace('{0}', 'o_orderdate')}||'","data_fim":""}}}},{{{{"nome":"Submissão de propostas","prazo":"de 02/01/'||{_Y.replace('{0}', 'o_orderdate')}||' até '||{dmy('o_orderdate')}||'","status":"aberto","data_inicio":"","data_fim":""}}}}]}}}}'
    ELSE '{{{{"fases":[{{{{"nome":"Inscrições","prazo":"","status":"","data_inicio":"","data_fim":"'||{dmy('o_orderdate')}||'"}}}},{{{{"nome":"  ","prazo":"x"}}}},{{{{"nome":"Resultado","prazo":"31/12/'||{_Y.replace('{0}', 'o_orderdate')}||'"}}}}]}}}}' END AS timeline_estimada
FROM orders
""".replace("'até {0}'", f"'até '||{dmy('o_orderdate')}").replace("{{", "{").replace("}}", "}")

ATTACHMENTS = """
SELECT doc_id AS id, CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'f'||CAST(doc_id AS STRING) END AS file_id, doc_id % 50 AS edital_id,
  CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS is_processed,
  source||'/'||lang||'/doc-'||CAST(doc_id % 700 AS STRING)||'.pdf' AS caminho_storage
FROM documents
"""

# listing pages: the given page with a block of notice links, by source of the page
_SRC = """(VALUES (0,'fapeal','https://www.fapeal.br','/2026/01/edital-'),(1,'fapema','https://www.fapema.br','/edital-fapema-'),
  (2,'fapepi','https://www.fapepi.pi.gov.br','/edital-'),(3,'fapergs','https://fapergs.rs.gov.br','/programa-'),
  (4,'fapesc','https://fapesc.sc.gov.br','/edital-de-chamada-'),(5,'fapespa','https://www.fapespa.pa.gov.br','/2026/09/14/noticia-'),
  (6,'fapesq','https://fapesq.rpp.br','/editais/2026/edital-no-'),(7,'fapitec','https://fapitec.se.gov.br','/editais-abertos/edital-'),
  (8,'fapt','https://www.to.gov.br','/fapt/amplia-'),(9,'cnpq','https://www.gov.br','/cnpq/chamadas/chamada-no-'),
  (10,'facepe','https://www.facepe.br','/editais/'),(11,'faperj','https://www.faperj.br','/rp/downloads/')) AS v(k, fonte, base, path)"""
_P = s("page_id")
_N = s("page_id % 40 + 1")
_PY = s("1996 + page_id % 3")
BLOCK = f"""'<ul><li><a href="/docs/edital-'||{_P}||'.pdf">Edital nº '||{_N}||'/'||{_PY}||' de fomento</a></li>'
||'<li><a href="docs/adendo-'||{_P}||'.pdf">ADENDO Nº 01/'||{_PY}||'</a> ao Edital Nº '||{_N}||'/'||{_PY}||'</li>'
||'<li><a href="/docs/errata-'||{_P}||'.pdf"> ERRATA </a></li>'
||'<li><a href="/docs/politica-de-uso-'||{_P}||'.pdf">Política de uso</a></li>'
||'<li><a href="https://finep.gov.br/images/res-'||{s('page_id % 20')}||'.pdf">Resultado final do Edital nº '||{_N}||'/'||{_PY}||'</a></li>'
||'<li><a class="x" href="'||path||{s('page_id % 60')}||'">Chamada <b>de projetos</b> nº '||{s('page_id % 60 + 1')}||' / '||{_PY}||'&nbsp;</a></li>'
||'<li><a href="javascript:void(0)">Saiba mais</a></li><li><a href="/category/edital/x">Editais abertos</a></li></ul>'
||'<p>Inscrições até: 1'||{s('page_id % 9')}||'/05/'||{_PY}||' Vigência: Aberto</p>'
||'<p>Inscrições: 01/02/'||{_PY}||' a 1'||{s('page_id % 9')}||'/03/'||{_PY}||'</p>'
||'<h2>Programa de bolsas '||{_P}||'</h2><p>Inscrições até: 10 de julho de '||{_PY}||'</p><a href="/s/'||{_P}||'.pdf">Arquivo</a>'
||'<h3>Curto</h3><p>x</p><h4>Seleção de projetos '||{_N}||'</h4><p>Inscrições até 03/04/'||{_PY}||'</p>'
||'<table><tbody><tr><td><a href="/chamadapublica/'||{s('page_id % 90')}||'">Seleção pública '||{_P}||'</a></td><td>01/02/'||{_PY}||'</td><td> 03/04/'||{_PY}||' </td></tr>'
||'<tr><td><a href="/chamadapublica/1">Chamadas públicas</a></td><td>x</td><td>y</td></tr></tbody></table>'
||'<a href="/financiamento/linha-'||{s('page_id % 30')}||'">Linha de inovação '||{_P}||'</a>'
||'<a href="#collapse-'||{_P}||'">Prêmio '||{_P}||' +</a><div id="collapse-'||{_P}||'"><a href="/c/'||{_P}||'.pdf">Regulamento</a></div>'"""
LISTINGS = f"""
SELECT page_id, v.fonte AS fonte, v.base||'/lista/'||{_P} AS url, replace(html, '</article>', {BLOCK}||'</article>') AS html
FROM pages JOIN {_SRC} ON page_id % 12 = v.k
"""
DETAILS = f"""
SELECT page_id, v.base||v.path||{s('page_id % 60')} AS url,
  CASE WHEN page_id % 4 = 0 THEN replace(html, '<h1>', '<h1>Edital de seleção nº '||{_N}||'/'||{_PY}||' ') ELSE html END AS h0,
  replace(CASE WHEN page_id % 4 = 0 THEN replace(html, '<h1>', '<h1>Edital de seleção nº '||{_N}||'/'||{_PY}||' ') ELSE html END, '</article>',
    '<p>Publicado em 05/03/'||{_PY}||', prazo 06/04/'||{_PY}||'</p><a href="/anexo-'||{_P}||'.pdf">Anexo</a></article>') AS html
FROM pages JOIN {_SRC} ON page_id % 12 = v.k
"""
HUBS = f"""
SELECT page_id, 'https://www.bndes.gov.br/wps/portal/site/home/hub-'||{s('page_id % 3')} AS url, replace(html, '</article>',
  '<a href="/wps/portal/site/home/chamada-'||{s('page_id % 70')}||'">Chamada pública '||{_P}||' - '||{_PY}||'</a>'
  ||'<a href="/wps/portal/x?1dmy'||'&'||'urile=wcm%3Apath%3A/Editais/'||{s('page_id % 25')}||'/">Seleção '||{_P}||'</a>'
  ||'<a href="/wps/wcm/connect/edital.htm">Edital</a><a href="/doc/edital.pdf">Edital</a><a href="mailto:x@y">Edital</a>'
  ||'<a href="https://outro.br/edital">Edital</a><a href="/wps/portal/site/home/chamada-antiga-'||{_P}||'">Chamada 1990 - 2001</a></article>') AS html
FROM pages
"""
CALLS = f"""
SELECT page_id, 'https://www.bndes.gov.br/chamada/'||{_P} AS url, replace(replace(html, '<h1>', '<h1 class="tituloConteudoInterna">Chamada '||{s('page_id % 180')}||' '), '</article>',
  '<p>O BNDES lançou, em '||{s('page_id % 28 + 1')}||'.02.'||{_PY}||' a chamada de projetos de restauração.</p>'
  ||'<p>Inscrições abertas de 01.03.'||{_PY}||' a '||{s('page_id % 31 + 1')}||'.0'||{s('page_id % 9 + 1')}||'.'||{_PY}||'.</p>'
  ||CASE WHEN page_id % 3 = 0 THEN '<p>Prazo de envio prorrogado até as 18h do dia 15/11/'||{_PY}||'</p>' ELSE '' END
  ||'<p>Envio de dúvidas até 30/12/2030</p><ul><li><a href="/wps/faq-'||{_P}||'.pdf">Perguntas</a></li><li><a href="/wps/logo.pdf">Imagem</a></li>'
  ||'<li><a href="/wps/ed-'||{_P}||'.pdf">Edital completo</a></li><li><a href="/wps/ED-'||{_P}||'.PDF">Edital de novo</a></li></ul></article>') AS html
FROM pages
"""

CATALOGUE = """
SELECT id, numero, fonte, titulo, descricao, orgao, area, status, link, is_researcher, is_company, sobre_programa, criterios_elegibilidade, valor_projeto, CAST(NULL AS STRING) AS valor,
  CASE WHEN id % 9 = 0 THEN NULL ELSE data_publicacao END AS data_encerramento, criado_em, CASE WHEN id % 5 = 0 THEN NULL ELSE criado_em END AS validado_em
FROM notices WHERE id % 10 < 4
"""
PROFILES = """
SELECT c_custkey AS user_id, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'pesquisador' WHEN 2 THEN 'consultor' ELSE 'ambos' END AS user_type,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '1-Urgent' WHEN 3 THEN '2-HIGH' WHEN 4 THEN 'bolsa%pesquisa' ELSE '_-low' END AS area,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '12.345.678/0001-'||CAST(c_custkey AS STRING) END AS cnpj, c_custkey % 5 <> 0 AS has_cnpj
FROM customer
"""
COMPANIES = """
SELECT s_suppkey AS id, s_suppkey * 2 AS owner_user_id, 'Empresa '||CAST(s_suppkey AS STRING) AS razao_social,
  CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '123456780001'||CAST(s_suppkey * 2 AS STRING) END AS cnpj, CASE s_suppkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN '3-Medium' ELSE '5-low' END AS area
FROM supplier
"""
REQUESTS = """
SELECT user_id, CAST(NULL AS BIGINT) AS empresa_id, CAST(CASE user_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 7 ELSE 90 END AS INT) AS p_limit FROM profiles WHERE user_id % 7 <> 0
UNION ALL SELECT CASE WHEN id % 10 = 0 THEN owner_user_id + 1 ELSE owner_user_id END, id, CAST(10 AS INT) FROM companies
UNION ALL SELECT user_id + 100000000, CAST(NULL AS BIGINT), CAST(3 AS INT) FROM profiles WHERE user_id % 7 = 0
"""
PROJECTS = """
SELECT o_orderkey AS id, o_custkey AS owner_user_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 97 END AS empresa_id,
  CASE o_orderkey % 50 WHEN 0 THEN 'todos' WHEN 1 THEN 'empresa' ELSE 'ambos' END AS publico_alvo, CASE o_orderkey % 40 WHEN 0 THEN 'x' ELSE 'ativo' END AS status, o_orderkey % 30 AS uf_form
FROM orders
"""
PROPOSALS = """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS projeto_id, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_suppkey END AS empresa_id FROM lineitem
"""

# model answers: one per event, of every shape an answer can have
_FIELD = "CASE CAST(floor(event_id / 500) AS BIGINT) % 9 WHEN 0 THEN 'valor_projeto' WHEN 1 THEN 'prazo_inscricao' WHEN 2 THEN 'localizacao' WHEN 3 THEN 'vagas' WHEN 4 THEN 'is_researcher' WHEN 5 THEN 'is_company' WHEN 6 THEN 'sobre_programa' WHEN 7 THEN 'criterios_elegibilidade' ELSE 'timeline_estimada' END"
_VALUE = """CASE WHEN field IN ('is_researcher', 'is_company') THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
  WHEN field = 'timeline_estimada' THEN '{"fases":[{"nome":" Inscrição ","prazo":"até 10/05/1998"},{"nome":""}]}'
  WHEN field = 'valor_projeto' THEN '{"por_projeto":["até R$ 5.000,00"]}' ELSE '"texto '||CAST(event_id AS STRING)||'"' END"""
RESPONSES = f"""
SELECT event_id, notice_id, field, stage, batch, timed_out, CASE event_id % 7 WHEN 0 THEN '{{"'||field||'":'||val||'}}' WHEN 1 THEN 'Segue ```json {{"'||field||'": '||val||'}} ```' WHEN 2 THEN '{{"'||field||'": '
  WHEN 3 THEN '{{"outro":1}}' WHEN 4 THEN '{{"'||field||'":null}}' WHEN 5 THEN '{{"'||field||'":12}}' ELSE '{{"'||field||'":"Não informado"}}' END AS raw
FROM (SELECT event_id, notice_id, field, stage, batch, timed_out, {_VALUE} AS val FROM
  (SELECT event_id, event_id % 500 AS notice_id, {_FIELD} AS field, CASE CAST(floor(event_id / 4500) AS BIGINT) % 3 WHEN 0 THEN 'topk' WHEN 1 THEN 'chunkscan' ELSE 'window' END AS stage,
   CAST(event_id % 5 AS INT) AS batch, event_id % 11 = 0 AS timed_out FROM events) AS r0) AS r1
"""

# audit answers of every decision, valid and not
AUDITS = """
SELECT event_id, event_id % 300 AS notice_id, CAST(floor(event_id / 300) AS BIGINT) % 4 AS fk, CASE CAST(floor(event_id / 300) AS BIGINT) % 4 WHEN 0 THEN 'prazo_inscricao' WHEN 1 THEN 'is_company' WHEN 2 THEN 'sobre_programa' ELSE 'timeline_estimada' END AS field,
  event_id % 9 AS form, event_id % 13 = 0 AS timed_out FROM events
"""
DOMAIN_EVENTS = """
SELECT event_id, event_type, user_id, ts, CASE WHEN event_id % 50 = 0 THEN '{"id": "e'||CAST(event_id AS STRING) ELSE '{"id":"'||CASE WHEN event_id % 41 = 0 THEN '  ' ELSE 'e'||CAST(event_id AS STRING) END||'","name":"'||CASE WHEN event_id % 37 = 0 THEN '' ELSE 'Job_'||event_type END||'","severity":"'||
  CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'info' WHEN 'signup' THEN 'warn' WHEN 'view' THEN 'fatal' ELSE 'debug' END||'","message":"valor '||CAST(user_id AS STRING)||'","at":"'||CASE WHEN event_id % 43 = 0 THEN '0001-01-01T00:00:00Z' ELSE '2024-02-03T0'||CAST(event_id % 10 AS STRING)||':15:07Z' END||'"'||
  CASE WHEN event_id % 2 = 0 THEN ',"component":"comp.a"' ELSE '' END||CASE WHEN event_id % 3 = 0 THEN ',"trace":{"trace_id":"t'||CAST(event_id AS STRING)||'"}' ELSE '' END||CASE WHEN event_id % 5 = 0 THEN ',"actor":{"user_id":"u'||CAST(user_id AS STRING)||'"},"request":{"method":"GET","path":"/x"}' ELSE '' END||
  CASE WHEN event_id % 7 = 0 THEN ',"error":{"type":"E","message":"falhou","stack":"'||repeat('s', CAST(1490 + event_id % 20 AS INT))||'"}' ELSE '' END||'}' END AS detail FROM events
"""

DERIVED: dict[str, tuple[str, tuple[str, ...]]] = {
    "notices": (NOTICES, ("orders",)),
    "attachments": (ATTACHMENTS, ("documents",)),
    "listings": (LISTINGS, ("pages",)),
    "details": (f"SELECT page_id, url, html FROM ({DETAILS}) AS d", ("pages",)),
    "hubs": (HUBS, ("pages",)),
    "calls": (CALLS, ("pages",)),
    "catalogue": (CATALOGUE, ("notices",)),
    "profiles": (PROFILES, ("customer",)),
    "companies": (COMPANIES, ("supplier",)),
    "requests": (REQUESTS, ("profiles", "companies")),
    "projects": (PROJECTS, ("orders",)),
    "proposals": (PROPOSALS, ("lineitem",)),
    "responses": (RESPONSES, ("events",)),
    "audits": (AUDITS, ("events",)),
    "domain_events": (DOMAIN_EVENTS, ("events",)),
}


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of all documents with the metadata and embeddings the index holds."""
    from pyspark.sql import functions as F

    from ..operators.chunks import chunk_documents

    c = chunk_documents(derive(spark, folder, "documents"))
    vectors = derive(spark, folder, "embeddings")
    n = vectors.agg(F.max("vec_id") + 1).scalar()
    k = F.col("doc_id")
    c = c.withColumn("vec_id", (k * 7 + F.col("chunk_index")) % n)
    c = c.join(vectors.select("vec_id", "embedding"), "vec_id")
    return c.select(
        (k * 100000 + F.col("chunk_index")).alias("id"),
        F.concat(F.lit("f"), k).alias("file_id"),
        "content",
        F.struct(
            F.when(k % 3 == 0, F.concat(F.lit("f"), k)).alias("file_id"),
            F.when(k % 2 == 0, (k % 50).cast("string")).alias("edital_id"),
            F.when(k % 23 != 0, F.col("chunk_index")).alias("chunk_index"),
        ).alias("metadata"),
        F.when(k % 17 != 0, F.col("embedding")).alias("embedding"),
        F.when(k % 5 != 0, F.col("embedding")).alias("embedding_perguntas"),
        F.timestamp_add("day", (k % 30).cast("int"), F.lit("1998-07-01").cast("timestamp")).alias("criado_em"),
        k.alias("doc_id"),
        "chunk_index",
    )


_WS = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
_CLEAN = f"trim(regexp_replace(replace(regexp_replace({{0}}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g'), chr(92), ' '), '{_WS.replace('{', '{{').replace('}', '}}')}+', ' ', 'g'))"
CHUNKS_DUCK = f"""
SELECT doc_id * 100000 + chunk_index AS id, 'f'||CAST(doc_id AS VARCHAR) AS file_id, content, CASE WHEN doc_id % 3 = 0 THEN 'f'||CAST(doc_id AS VARCHAR) END AS m_file_id,
 CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 50 AS VARCHAR) END AS m_edital_id, CASE WHEN doc_id % 23 <> 0 THEN chunk_index END AS m_index,
 CASE WHEN doc_id % 17 <> 0 THEN embedding END AS embedding, CASE WHEN doc_id % 5 <> 0 THEN embedding END AS embedding_perguntas,
 TIMESTAMP '1998-07-01' + to_days(CAST(doc_id % 30 AS INT)) AS criado_em, doc_id, chunk_index
FROM (SELECT doc_id, content, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_index FROM
  (SELECT doc_id, i, {_CLEAN.format("substring(t, CAST(i*600+1 AS BIGINT), 800)")} AS content FROM
    (SELECT doc_id, t, unnest(generate_series(0, greatest(CAST(ceil((length(t)-800)/600.0) AS BIGINT), 0))) AS i FROM
      (SELECT doc_id, trim(regexp_replace(text, '{_WS}+', ' ', 'g')) AS t FROM documents) a WHERE t <> '') b) c WHERE content <> '') d
JOIN embeddings e ON e.vec_id = (doc_id * 7 + chunk_index) % (SELECT max(vec_id) + 1 FROM embeddings)
"""

#: Frames whose DuckDB SQL differs from the Spark plan: (builder, DuckDB SQL, inputs).
BUILT = {"chunks": (_chunks, CHUNKS_DUCK, ("documents", "embeddings"))}


def derive(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived frame (or a given table) as a DataFrame."""
    if name in BUILT:
        return BUILT[name][0](spark, folder)
    if name not in DERIVED:
        return table(spark, folder, name)
    sql, inputs = DERIVED[name]
    # double braces keep literal JSON braces apart from the named inputs
    text = sql.replace("{", "{{").replace("}", "}}")
    for t in inputs:
        text = _from(text, t)
    return spark.sql(text, **{t: derive(spark, folder, t) for t in inputs})


def _from(text: str, name: str) -> str:
    for word in ("FROM ", "JOIN "):
        text = text.replace(f"{word}{name}", f"{word}{{{name}}} AS {name}")
    return text


def ctes(*names: str) -> str:
    """``WITH`` prefix for DuckDB holding the named derived frames and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        if n in order or (n not in DERIVED and n not in BUILT):
            return
        for dep in BUILT[n][2] if n in BUILT else DERIVED[n][1]:
            add(dep)
        order.append(n)

    for n in names:
        add(n)
    return ",\n".join(f"{n} AS ({BUILT[n][1] if n in BUILT else DERIVED[n][0]})" for n in order)
