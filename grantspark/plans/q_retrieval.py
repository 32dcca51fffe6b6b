"""Queries of the retrieval group (2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import FIELDS
from ..functions import prompts
from ..functions.text import strip
from ..operators import catalogue as C
from ..operators import retrieval as R
from . import duck as d
from .registry import query

_FILES = "fk AS (SELECT DISTINCT CAST(edital_id AS VARCHAR) AS notice_id, k AS file_key FROM (SELECT edital_id, CAST(id AS VARCHAR) AS k FROM attachments UNION ALL SELECT edital_id, file_id FROM attachments) t WHERE k <> '')"
_PAIRS = f"""{_FILES},
pr AS (SELECT m_edital_id AS notice_id, id FROM chunks WHERE m_edital_id IS NOT NULL UNION SELECT fk.notice_id, c.id FROM chunks c JOIN fk ON c.file_id = fk.file_key
 UNION SELECT fk.notice_id, c.id FROM chunks c JOIN fk ON c.m_file_id = fk.file_key)"""
_ORD = f"""{_PAIRS}, od AS (SELECT pr.notice_id, pr.id, c.file_id, c.content, c.m_index, c.embedding, c.embedding_perguntas,
 row_number() OVER (PARTITION BY pr.notice_id ORDER BY coalesce(c.m_index, -1), pr.id) AS pos FROM pr JOIN chunks c ON c.id = pr.id)"""
USES = "chunks attachments"


def _pairs(f):
    return R.associate_chunks(f.stored("chunks"), f.attachments)


def _keys(f):
    """Chunks with text, without text and vectors."""
    return f.stored("chunk_keys", lambda: f.chunks.where(strip("content") != "").select("id", "file_id", "metadata"))


def _pairs_only(f):
    """The pairs where no text or vector is read later: only keys are stored."""
    return R.associate_chunks(_keys(f), f.attachments)


def _ordered(f):
    """Reading order where texts but no vectors are read later: no vectors are stored."""
    texts = f.stored("chunk_texts", lambda: f.chunks.select("id", "file_id", "metadata", "content"))
    return R.reading_order(R.notice_chunks(R.associate_chunks(texts, f.attachments), texts, "file_id", "content"))


@query("associate_chunks", USES, f"WITH {_PAIRS} SELECT * FROM pr")
def associate_chunks(f):
    return _pairs_only(f)


@query("rank_notices_by_chunks", USES, f"WITH {_PAIRS} SELECT notice_id, count(DISTINCT id) AS chunks FROM pr GROUP BY 1")
def rank_notices_by_chunks(f):
    return R.rank_notices_by_chunks(_pairs_only(f))


@query("reading_order", USES, f"WITH {_ORD} SELECT notice_id, id, pos FROM od")
def reading_order(f):
    ordered = R.reading_order(R.notice_chunks(_pairs_only(f), _keys(f), "file_id"))
    return ordered.select("notice_id", "id", F.col("pos").cast("long").alias("pos"))


_SPANS = f"{_ORD}, sp AS (SELECT notice_id, id, pos, CAST(e - n AS BIGINT) AS start, CAST(e AS BIGINT) AS \"end\" FROM (SELECT *, length(content) AS n, sum(length(content) + 2) OVER (PARTITION BY notice_id ORDER BY pos) - 2 AS e FROM od) t)"
_LEN = f"{_SPANS}, ln AS (SELECT notice_id, max(\"end\") AS plain_len FROM sp GROUP BY 1)"


@query("plain_text_spans", USES, f"WITH {_SPANS} SELECT notice_id, id, start, \"end\" FROM sp")
def plain_text_spans(f):
    return R.plain_text_spans(_ordered(f)).select("notice_id", "id", "start", "end")


_SLIDE = f"""{_LEN}, sw AS (SELECT notice_id, i AS window_index, i * 2000 AS w_start, least(plain_len, i * 2000 + 3000) AS w_end FROM
 (SELECT notice_id, plain_len, unnest(range(0, CAST(ceil(greatest(plain_len - 3000, 0) / 2000.0) AS BIGINT) + 1)) AS i FROM ln) t)"""


def _windows(f):
    return R.sliding_windows(R.plain_lengths(_ordered(f)))


@query("sliding_windows", USES, f"WITH {_SLIDE} SELECT * FROM sw")
def sliding_windows(f):
    return _windows(f).select("notice_id", *[F.col(c).cast("long").alias(c) for c in ("window_index", "w_start", "w_end")])


@query("span_overlap_join", USES, f"WITH {_SLIDE} SELECT sp.notice_id, window_index, sp.id FROM sp JOIN sw ON sp.notice_id = sw.notice_id AND sp.\"end\" > w_start AND sp.start < w_end")
def span_overlap_join(f):
    spans = f.stored("spans", lambda: R.plain_text_spans(_ordered(f)))
    out = R.span_overlap_join(spans, R.sliding_windows(R.span_lengths(spans)))
    return out.withColumn("window_index", F.col("window_index").cast("long"))


_FIELDROWS = "(VALUES " + ",".join(f"({i},'{n}')" for i, n in enumerate(FIELDS)) + ") AS fv(k, field)"
_QV = f"qv AS (SELECT fv.field, CAST(e.embedding AS DOUBLE[]) AS vector FROM embeddings e JOIN {_FIELDROWS} ON e.vec_id = fv.k)"
_SCORES = f"""{_ORD}, {_QV}, ve AS (SELECT notice_id, id, content, CAST(coalesce(embedding_perguntas, embedding) AS DOUBLE[]) AS v FROM od WHERE coalesce(embedding_perguntas, embedding) IS NOT NULL),
sc AS (SELECT notice_id, field, id, list_cosine_similarity(v, vector) AS score FROM ve CROSS JOIN qv)"""


def _queries(f):
    names = F.element_at(F.create_map(*[x for i, n in enumerate(FIELDS) for x in (F.lit(i), F.lit(n))]), F.col("vec_id").cast("int"))
    return R.query_vectors(f.embeddings.where(F.col("vec_id") < len(FIELDS)).select(names.alias("field"), F.col("embedding").alias("vector")))


def _scores(f):
    return R.cosine_scores(R.notice_chunks(_pairs(f), f.stored("chunks"), "embedding", "embedding_perguntas"), _queries(f))


@query("cosine_scores", USES, f"WITH {_SCORES} SELECT notice_id, field, id, round(score, 6) AS score FROM sc")
def cosine_scores(f):
    return _scores(f).select("notice_id", "field", "id", F.round("score", 6).alias("score"))


def _values(f):
    """Value wording of the notices, and the given texts."""
    return f.notices.select(F.col("id").cast("string").alias("k"), F.col("valor_projeto").alias("content")).unionByName(
        f.documents.select(F.concat(F.lit("d"), "doc_id").alias("k"), F.col("text").alias("content"))
    )


_BONUS = f"""CASE WHEN NOT {d.has('content', 'R\\$\\s*\\d')} THEN 0.0 WHEN {d.has('content', '(^|[^0-9A-Za-z_])(?:por|cada|para cada)\\s+(?:proposta|projeto|empresa|plano)|(^|[^0-9A-Za-z_])valor\\s+(?:m[aá]ximo|m[ií]nimo|global|total)|(^|[^0-9A-Za-z_])teto($|[^0-9A-Za-z_])|(^|[^0-9A-Za-z_])recursos?\\s+(?:financeiros?\\s+)?(?:destinad|dispon[ií]ve|previst|or[cç]ad)')} THEN 0.3 ELSE 0.15 END"""


@query("lexical_bonus", "notices", f"SELECT k, CAST({_BONUS} AS DOUBLE) AS bonus FROM (SELECT CAST(id AS VARCHAR) AS k, valor_projeto AS content FROM notices UNION ALL SELECT 'd'||CAST(doc_id AS VARCHAR), text FROM documents) t")
def lexical_bonus(f):
    return R.add_lexical_bonus(_values(f)).select("k", "bonus")


_TOPK = f"""{_SCORES}, tk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY notice_id, field ORDER BY score DESC, id) AS rn FROM sc) t
 WHERE rn <= CASE field WHEN 'valor_projeto' THEN 25 WHEN 'prazo_inscricao' THEN 60 WHEN 'timeline_estimada' THEN 70 WHEN 'criterios_elegibilidade' THEN 55 WHEN 'sobre_programa' THEN 45 ELSE 35 END)"""


def _top(f):
    rows = R.add_lexical_bonus(R.notice_chunks(_pairs(f), f.stored("chunks"), "embedding", "embedding_perguntas", "content")).drop("content")
    return R.topk_by_field(R.cosine_scores(rows, _queries(f), keep=("notice_id", "id", "bonus")))


@query("topk_by_field", USES, f"WITH {_TOPK} SELECT notice_id, field, id, rn, round(score, 6) AS score FROM tk")
def topk_by_field(f):
    return _top(f).select("notice_id", "field", "id", F.col("rn").cast("long").alias("rn"), F.round("score", 6).alias("score"))


_BLK = f"{_TOPK}, bl AS (SELECT tk.notice_id, tk.field, tk.rn, tk.id, c.m_index, '--- Documento '||left(c.file_id, 12)||' / chunk '||coalesce(CAST(c.m_index AS VARCHAR),'?')||' ---'||chr(10)||c.content AS piece FROM tk JOIN chunks c ON c.id = tk.id)"


def _blocks(f):
    return R.with_blocks(_top(f), f.stored("chunks"))


@query("pack_context_by_score", USES, f"""WITH {_BLK}, us AS (SELECT *, sum(length(piece) + 2) OVER (PARTITION BY notice_id, field ORDER BY rn) - 2 AS used FROM bl)
SELECT notice_id, field, string_agg(left(piece, 3000), chr(10)||chr(10) ORDER BY rn) AS context, count(*) AS pieces FROM us WHERE used <= 3000 OR rn = 1 GROUP BY 1, 2""")
def pack_context_by_score(f):
    return R.pack_context_by_score(_blocks(f)).drop("first_id")


@query("pack_context_reading", USES, f"""WITH {_BLK} SELECT notice_id, field, left(string_agg(piece, chr(10)||chr(10) ORDER BY coalesce(m_index,-1), id), 3000) AS context FROM bl GROUP BY 1, 2""")
def pack_context_reading(f):
    return R.pack_context_reading(_blocks(f)).drop("pieces")


@query("pack_context_reading_sample", USES, f"""WITH {_ORD}, ov AS (SELECT *, row_number() OVER (PARTITION BY notice_id ORDER BY pos) AS vp FROM od WHERE coalesce(embedding_perguntas, embedding) IS NOT NULL)
SELECT notice_id, left(string_agg('--- Documento '||left(file_id, 12)||' ---'||chr(10)||content, chr(10)||chr(10) ORDER BY pos), 6000) AS context FROM ov WHERE vp <= 100 GROUP BY 1""")
def pack_context_reading_sample(f):
    usable = f.stored("chunks").where("embedding_perguntas IS NOT NULL OR embedding IS NOT NULL")
    return R.sample_context(R.reading_order(R.notice_chunks(_pairs(f), usable, "file_id", "content")))


@query("topk_batches", USES, f"WITH {_BLK} SELECT notice_id, field, CAST(floor((rn-1)/3) AS BIGINT) AS batch, left(string_agg(piece, chr(10)||chr(10) ORDER BY rn), 3000) AS context, count(*) AS pieces FROM bl GROUP BY 1, 2, 3")
def topk_batches(f):
    return R.topk_batches(_blocks(f)).drop("first_id").withColumn("batch", F.col("batch").cast("long"))


@query("scan_batches", USES, f"""WITH {_ORD},
x AS (SELECT notice_id, pos, '--- Documento '||left(file_id, 12)||' / chunk '||coalesce(CAST(m_index AS VARCHAR),'?')||' ---'||chr(10)||content AS piece FROM od),
w AS (SELECT notice_id, pos, 1 AS items, length(piece) AS chars, CAST(0 AS BIGINT) AS batch FROM x WHERE pos = 1 UNION ALL
 SELECT x.notice_id, x.pos, CASE WHEN w.items >= 3 OR w.chars + 2 + length(x.piece) > 3000 THEN 1 ELSE w.items + 1 END, CASE WHEN w.items >= 3 OR w.chars + 2 + length(x.piece) > 3000 THEN length(x.piece) ELSE w.chars + 2 + length(x.piece) END,
 CASE WHEN w.items >= 3 OR w.chars + 2 + length(x.piece) > 3000 THEN w.batch + 1 ELSE w.batch END FROM w JOIN x ON x.notice_id = w.notice_id AND x.pos = w.pos + 1)
SELECT w.notice_id, w.batch, left(string_agg(x.piece, chr(10)||chr(10) ORDER BY x.pos), 3000) AS context, count(*) AS pieces FROM w JOIN x ON x.notice_id = w.notice_id AND x.pos = w.pos GROUP BY 1, 2""", recursive=True)
def scan_batches(f):
    return R.scan_batches(_ordered(f)).drop("first_id").withColumn("batch", F.col("batch").cast("long"))


@query("spread_windows", USES, f"""WITH {_LEN} SELECT notice_id, CAST(row_number() OVER (PARTITION BY notice_id ORDER BY w_start) - 1 AS BIGINT) AS window_index, w_start, least(plain_len, w_start + 8000) AS w_end FROM
 (SELECT DISTINCT notice_id, plain_len, CASE WHEN plain_len <= 8000 THEN 0 ELSE CAST(floor((plain_len - 8000) * i / 5.0 + 0.5) AS BIGINT) END AS w_start FROM ln CROSS JOIN range(0, 6) r(i)) t""")
def spread_windows(f):
    out = R.spread_windows(R.plain_lengths(_ordered(f)), 8000, 6)
    return out.select("notice_id", *[F.col(c).cast("long").alias(c) for c in ("window_index", "w_start", "w_end")])


@query("window_plan", USES, f"""WITH {_LEN}, p AS (SELECT ln.notice_id, fv.field, plain_len, (CAST(notice_id AS BIGINT) + k) % 2 = 0 AS fin, (CAST(notice_id AS BIGINT) + k) % 5 = 0 AS tmo FROM ln CROSS JOIN {_FIELDROWS})
SELECT notice_id, field, CASE WHEN plain_len >= 40000 THEN 0 ELSE 1000 END AS overlap, least(24, CASE WHEN fin THEN 6 ELSE 24 END, CASE WHEN tmo THEN CASE WHEN field IN ('is_researcher','is_company') THEN 2 ELSE 3 END ELSE 24 END,
  CASE WHEN plain_len >= 40000 THEN 8 WHEN plain_len >= 20000 THEN 10 ELSE 24 END) AS max_windows, plain_len >= 20000 AS spread,
 tmo OR NOT ((field IN ('is_researcher','is_company') AND fin) OR (fin AND plain_len >= 20000 AND field NOT IN ('timeline_estimada','prazo_inscricao'))) AS scan_needed FROM p""")
def window_plan(f):
    rows = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(n).alias("field")) for i, n in enumerate(FIELDS)])
    ln = R.plain_lengths(_ordered(f)).select("notice_id", "plain_len", F.inline(rows))
    at = F.col("notice_id").cast("long") + F.col("k")
    plan = R.window_plan(ln.select("notice_id", "field", "plain_len", (at % 2 == 0).alias("topk_finished"), (at % 5 == 0).alias("topk_timed_out")), 20000, 40000)
    return plan.select("notice_id", "field", "overlap", "max_windows", "spread", "scan_needed")


@query("subsample_long", USES, f"""WITH {_ORD},
r AS (SELECT notice_id, id, pos, length(content) + 2 AS w FROM od),
z AS (SELECT notice_id, count(*) AS total, sum(w) - 2 AS chars, greatest(1, CAST(ceil(count(*) * 0.22) AS INT)) AS cut FROM r GROUP BY 1),
q AS (SELECT r.*, total, cut, CASE WHEN chars <= 20000 THEN 'all' WHEN pos <= cut THEN 'head' WHEN pos > total - cut THEN 'tail' ELSE 'middle' END AS part FROM r JOIN z ON r.notice_id = z.notice_id),
g AS (SELECT notice_id, sum(w) FILTER (WHERE part='head') - 2 AS hc, sum(w) FILTER (WHERE part='tail') - 2 AS tc, greatest(coalesce(sum(w) FILTER (WHERE part='middle'),0) - 2, 0) AS mc, count(*) FILTER (WHERE part='middle') AS mn FROM q WHERE part <> 'all' GROUP BY 1),
b AS (SELECT *, greatest(0, 20000 - hc - tc) AS budget, greatest(1, ceil(mn / greatest(1, ceil(greatest(0, 20000 - hc - tc) / greatest(80, floor(mc * 1.0 / nullif(mn,0)))))::DOUBLE)) AS step FROM g),
c AS (SELECT q.*, b.hc, b.tc, coalesce(sum(w) OVER (PARTITION BY q.notice_id, part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + hc AS before FROM q LEFT JOIN b ON q.notice_id = b.notice_id
  WHERE part <> 'middle' OR (budget > 0 AND (pos - cut - 1) % CAST(step AS BIGINT) = 0))
SELECT notice_id, id, part FROM c WHERE part <> 'middle' OR before < 20000 - tc""")
def subsample_long(f):
    return R.subsample_long(_ordered(f), 20000).select("notice_id", "id", "part")


# generic terms found in the given texts
_TERMS = (("tion", 4), ("the", 3), ("[éè]", 2), ("ing", 1))
_KW = " + ".join(f"CASE WHEN {d.has('content', p)} THEN {w} ELSE 0 END" for p, w in _TERMS)


@query("keyword_rank_context", f"{USES} notices", f"""WITH {_ORD},
k AS (SELECT notice_id, id, content, {_KW} AS kw FROM od),
r AS (SELECT *, row_number() OVER (PARTITION BY notice_id ORDER BY kw DESC, id) AS rn FROM k WHERE kw > 0),
bs AS (SELECT CAST(id AS VARCHAR) AS notice_id, 'SOBRE O PROGRAMA: '||coalesce(sobre_programa,'') AS base FROM notices WHERE id < 60),
p AS (SELECT r.*, base, coalesce(sum(length(content) + 5) OVER (PARTITION BY r.notice_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(base) + length(content) > 6000 AS big FROM r JOIN bs ON r.notice_id = bs.notice_id WHERE rn <= 16),
o AS (SELECT *, max(CASE WHEN big THEN 1 ELSE 0 END) OVER (PARTITION BY notice_id ORDER BY rn) AS over FROM p)
SELECT bs.notice_id, any_value(bs.base)||coalesce(string_agg(chr(10)||'---'||chr(10)||content, '' ORDER BY rn), '') AS context, count(content) AS pieces FROM bs LEFT JOIN o ON o.notice_id = bs.notice_id AND over = 0 GROUP BY 1""".replace(" WHERE id < 60", ""))
def keyword_rank_context(f):
    rows = R.notice_chunks(_pairs(f), f.stored("chunks"), "content")
    base = f.notices.select(F.col("id").cast("string").alias("notice_id"), F.concat(F.lit("SOBRE O PROGRAMA: "), F.coalesce("sobre_programa", F.lit(""))).alias("base"))
    return R.keyword_rank_context(rows, _TERMS, 16, 6000, base=base)


_LINE = "'Edital: '||coalesce(nullif(numero,''),'N/A')||' — '||coalesce(titulo,'')||' ('||coalesce(nullif(fonte,''),'N/A')||')'"


@query("build_requests_query_text", "notices", "WITH h AS (SELECT * FROM (VALUES " + ",".join(f"({d.q(n)},{d.q(R.QUERY_HINTS[n])})" for n in FIELDS) + f""") AS v(field, hint))
SELECT id AS notice_id, field, '{R.QUERY_PREFIX}'||chr(10)||'Campos relacionados: '||field||chr(10)||'Perguntas exemplo: Que informações do edital respondem a este campo? '||hint||chr(10)||chr(10)||{_LINE}||chr(10)||'Campo: '||field||chr(10)||{d.q(R.QUERY_TASK)}||chr(10)||hint AS query_text FROM notices CROSS JOIN h""")
def build_requests_query_text(f):
    return R.build_field_queries(f.notices)


_EX = "CASE field " + " ".join(f"WHEN '{n}' THEN {d.q(prompts.example(n))}" for n in FIELDS) + " END"
_VR = "||chr(10)||".join(d.q(x) for x in prompts.VALUE_RULES)
_HEADSQL = "||chr(10)||".join(d.q(x) for x in R.PROMPT_HEAD)


@query("build_requests", f"{USES} notices", f"""WITH {_BLK}, cx AS (SELECT notice_id, field, CAST(floor((rn-1)/3) AS BIGINT) AS batch, left(string_agg(piece, chr(10)||chr(10) ORDER BY rn), 3000) AS context FROM bl GROUP BY 1, 2, 3)
SELECT cx.notice_id, field, 'topk' AS stage, batch, {_HEADSQL}||chr(10)||chr(10)||{_LINE}||chr(10)||chr(10)||'Campo: '||field||chr(10)||'Formato esperado (exemplo): '||{_EX}||chr(10)||chr(10)||'REGRAS CRÍTICAS:'||chr(10)||'- Responda em UMA linha JSON, exatamente com a chave "'||field||'"'
 ||chr(10)||'- Não inclua outras chaves'||chr(10)||'- Não inclua quebras de linha fora do JSON'||CASE WHEN field = 'valor_projeto' THEN chr(10)||{_VR} ELSE '' END||chr(10)||chr(10)||'CONTEÚDO:'||chr(10)||context AS prompt FROM cx JOIN notices n ON CAST(n.id AS VARCHAR) = cx.notice_id""")
def build_requests(f):
    out = R.build_requests(R.topk_batches(_blocks(f)), f.notices, "topk")
    return out.withColumn("batch", F.col("batch").cast("long"))


_AUDIT = "||chr(10)||".join(d.q(x) for x in prompts.AUDIT_HEAD)
_CELLS = " UNION ALL ".join(
    f"SELECT id, numero, titulo, fonte, '{c}' AS field, CASE WHEN coalesce(lower(trim({c})),'') NOT IN ('','não informado') THEN '\"'||{c}||'\"' ELSE 'null' END AS before FROM notices"
    for c in ("prazo_inscricao", "valor_projeto", "sobre_programa", "criterios_elegibilidade")
) + "".join(
    f" UNION ALL SELECT id, numero, titulo, fonte, '{c}', {text} FROM notices WHERE {filled}"
    for c, text, filled in (
        ("localizacao", "'\"'||localizacao||'\"'", "localizacao IS NOT NULL"), ("vagas", "'\"'||vagas||'\"'", "vagas IS NOT NULL"),
        ("is_researcher", "CAST(is_researcher AS VARCHAR)", "is_researcher IS NOT NULL"), ("is_company", "CAST(is_company AS VARCHAR)", "is_company IS NOT NULL"),
        ("timeline_estimada", "timeline_estimada", "json_array_length(timeline_estimada, '$.fases') > 0"),
    )
)


@query("build_requests_audit", "notices", f"""WITH c AS ({_CELLS}) SELECT id AS notice_id, field, {_AUDIT}||chr(10)||'Edital: '||coalesce(numero,'N/A')||' — '||titulo||chr(10)||'Fonte: '||fonte||chr(10)||chr(10)||'Campo: '||field||chr(10)||'Valor atual (extração): '||before||chr(10)||chr(10)
 ||CASE WHEN id % 2 = 0 THEN 'Trecho usado na extração (origem: topk):'||chr(10)||'trecho '||CAST(id AS VARCHAR)||chr(10)||'IDs em documents (linhas da extração): c'||CAST(id AS VARCHAR)||', x' ELSE {d.q(prompts.NO_EVIDENCE)} END||chr(10)||chr(10)||'Orientação do campo:'||chr(10)||CASE field {" ".join(f"WHEN '{n}' THEN {d.q(t)}" for n, t in prompts.GUIDANCE.items())} END
 ||chr(10)||chr(10)||'Formato de saída: APENAS JSON válido (uma linha se possível) com:'||chr(10)||'- a chave do campo "'||field||'" com o valor final (tipo correto: string, boolean, objeto timeline, ou null)'||chr(10)||'- a chave "_audit" com objeto {{ "decision": "accept"|"replace"|"reject", "reason": "breve, PT-BR" }}'
 ||chr(10)||'Exemplo de chaves: "'||field||'" e "_audit".'||chr(10)||'Referência de tipo/estrutura: '||CASE field {" ".join(f"WHEN '{n}' THEN {d.q(prompts.example(n, audit=True))}" for n in FIELDS)} END AS prompt FROM c""")
def build_requests_audit(f):
    targets = C.audit_targets(R.with_headings(f.notices), keep=R.HEADINGS).where("action = 'audit'")
    snippet = F.when(F.col("id") % 2 == 0, F.concat(F.lit("trecho "), "id"))
    ids = F.array(F.concat(F.lit("c"), "id"), F.lit(""), F.lit("x"))
    return R.build_audit_requests(targets.withColumns({"source": F.lit("topk"), "snippet": snippet, "document_ids": ids}))


@query("build_requests_stipend", f"{USES}", f"""WITH {_ORD}, k AS (SELECT notice_id, id, content, {_KW} AS kw FROM od), r AS (SELECT *, row_number() OVER (PARTITION BY notice_id ORDER BY kw DESC, id) AS rn FROM k),
p AS (SELECT *, coalesce(sum(length(content) + 5) OVER (PARTITION BY notice_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(content) > 12000 AS big FROM r WHERE rn <= 10), o AS (SELECT *, max(CASE WHEN big THEN 1 ELSE 0 END) OVER (PARTITION BY notice_id ORDER BY rn) AS over FROM p)
SELECT notice_id, 'valor_bolsa' AS field, {d.q(prompts.STIPEND_PROMPT)}||string_agg(chr(10)||'---'||chr(10)||content, '' ORDER BY rn) AS prompt FROM o WHERE over = 0 GROUP BY 1""")
def build_requests_stipend(f):
    rows = R.notice_chunks(_pairs(f), f.stored("chunks"), "content")
    return R.build_stipend_requests(R.keyword_rank_context(rows, _TERMS, 10, 12000, positive=False))
