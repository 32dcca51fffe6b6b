"""Queries of the chunk index group (2.4)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import chunks as C
from .derived import _CLEAN
from .registry import query

_KEYED = "ak AS (SELECT *, trim(coalesce(nullif(file_id,''), CAST(id AS VARCHAR))) AS file_key FROM attachments)"
_QUEUE = f"{_KEYED}, qu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY edital_id, id) AS rn FROM ak WHERE NOT coalesce(is_processed, false)) t WHERE rn = 1)"
_HEALTH = """hl AS (SELECT file_id, count(*) AS total, count(*) FILTER (WHERE length(trim(content)) >= 50) AS with_content, count(embedding) AS with_embedding,
 count(*) - count(embedding) AS missing, count(*) FILTER (WHERE length(trim(content)) >= 50) > 0 AND count(*) = count(embedding) AS fully_indexed FROM chunks GROUP BY 1)"""


@query("build_queue", "attachments", f"WITH {_QUEUE} SELECT file_key, id, edital_id FROM qu")
def build_queue(f):
    return C.build_queue(f.attachments).select("file_key", "id", "edital_id")


@query("requeue_stale", "attachments chunks", f"""WITH {_QUEUE}, {_HEALTH},
mk AS (SELECT * FROM ak WHERE is_processed),
m1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY edital_id DESC, id DESC) AS rn FROM mk) t WHERE rn = 1),
st AS (SELECT * FROM m1 WHERE file_key NOT IN (SELECT file_key FROM qu) AND file_key NOT IN (SELECT file_id FROM hl WHERE fully_indexed))
SELECT file_key, id FROM qu UNION ALL SELECT file_key, id FROM st""")
def requeue_stale(f):
    return C.requeue_stale(C.build_queue(f.attachments), f.attachments, C.index_health(f.chunks)).select("file_key", "id")


@query("index_health", "chunks", f"WITH {_HEALTH} SELECT * FROM hl")
def index_health(f):
    return C.index_health(f.chunks)


@query("purge_partial_chunks", "chunks attachments", """
SELECT id FROM chunks WHERE NOT (embedding IS NULL AND criado_em < TIMESTAMP '1998-07-15 00:00:00') AND NOT (embedding IS NULL AND file_id IN (SELECT file_id FROM attachments WHERE is_processed IS NULL))""")
def purge_partial_chunks(f):
    rebuilt = f.attachments.where("is_processed IS NULL")
    return C.purge_partial_chunks(f.chunks, datetime(1998, 7, 15), rebuilt).select("id")


@query("clean_text", "", f"SELECT doc_id, md5(t) AS h, length(t) AS n FROM (SELECT doc_id, {_CLEAN.format('text')} AS t FROM documents) x WHERE length(t) >= 50")
def clean_text(f):
    return C.clean_text(f.documents).select("doc_id", F.md5("text").alias("h"), F.length("text").cast("long").alias("n"))


@query("chunk_documents", "chunks", "SELECT doc_id, chunk_index, content FROM chunks")
def chunk_documents(f):
    return C.chunk_documents(f.documents).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "content")


def _answers(f):
    """A model answer per chunk: plain, fenced, broken or with odd lists."""
    k, i = F.col("doc_id"), F.col("chunk_index")
    body = F.concat(
        F.lit('{"tipos_de_pergunta":["Qual o valor?","tema '), k, F.lit('"],"campos_relacionados":["vagas","outro","'),
        F.when(k % 2 == 0, "localizacao").otherwise("valor_projeto"), F.lit('"],"perguntas_exemplo":'),
        F.when(k % 4 == 0, "[]").otherwise('["Quem pode?"]'), F.lit("}"),
    )
    raw = F.when(i % 4 == 0, F.concat(F.lit("Segue:\n```json\n"), body, F.lit("\n```"))).when(i % 4 == 1, body).when(
        i % 4 == 2, F.concat(F.lit("ok "), body, F.lit(" fim"))
    ).otherwise('{"tipos_de_pergunta":')
    return f.chunks.select("file_id", F.col("doc_id"), "chunk_index", "content", F.col("metadata.edital_id").alias("edital_id"), raw.alias("raw"))


_ANS = """an AS (SELECT *, chunk_index % 4 = 3 AS enrich_failed, 'Qual o valor?; tema '||CAST(doc_id AS VARCHAR) AS tipos,
 'vagas, '||CASE WHEN doc_id % 2 = 0 THEN 'localizacao' ELSE 'valor_projeto' END AS campos, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Quem pode?' END AS perguntas FROM chunks)"""


@query("parse_enrichment", "chunks", f"""WITH {_ANS} SELECT file_id, chunk_index, enrich_failed, CASE WHEN NOT enrich_failed THEN tipos END AS tipos,
 CASE WHEN NOT enrich_failed THEN campos END AS campos, CASE WHEN NOT enrich_failed THEN perguntas END AS perguntas FROM an""")
def parse_enrichment(f):
    e = C.parse_enrichment(_answers(f))
    return e.select(
        "file_id", F.col("chunk_index").cast("long").alias("chunk_index"), "enrich_failed",
        F.array_join("enrichment.tipos_de_pergunta", "; ").alias("tipos"), F.array_join("enrichment.campos_relacionados", ", ").alias("campos"),
        F.array_join("enrichment.perguntas_exemplo", " | ").alias("perguntas"),
    )


_COMPOSED = f"""{_ANS}, hd AS (SELECT *, CASE WHEN NOT enrich_failed THEN '[CONTEXTO PARA BUSCA — alinhado ao pipeline process-edital-info]'||chr(10)||'Tipos de pergunta: '||tipos||chr(10)||
 'Campos relacionados: '||campos||chr(10)||'Perguntas exemplo: '||coalesce(nullif(perguntas,''),'(nenhuma)') END AS header FROM an),
cp AS (SELECT file_id, chunk_index, CASE WHEN header IS NULL THEN content ELSE header||chr(10)||chr(10)||'[TRECHO DO EDITAL]'||chr(10)||content END AS content, coalesce(header, content) AS retrieval_text,
 enrich_failed AS failed, false AS skipped FROM hd)"""


def _composed(f):
    a = _answers(f)
    return C.compose_chunk_text(a.drop("raw"), C.parse_enrichment(a))


@query("compose_chunk_text", "chunks", f"WITH {_COMPOSED} SELECT file_id, chunk_index, content, retrieval_text, failed AS enrich_failed, skipped FROM cp")
def compose_chunk_text(f):
    return _composed(f).select(
        "file_id", F.col("chunk_index").cast("long").alias("chunk_index"), "content", "retrieval_text",
        F.col("metadata.enrich_failed").alias("enrich_failed"), F.col("metadata.enrich_skipped_llm").alias("skipped"),
    )


@query("split_retrieval_text", "chunks", f"WITH {_COMPOSED} SELECT file_id, chunk_index, CASE WHEN instr(content, '[TRECHO DO EDITAL]') > 1 THEN rtrim(left(content, instr(content, '[TRECHO DO EDITAL]') - 1), chr(10)) ELSE content END AS retrieval_text FROM cp")
def split_retrieval_text(f):
    out = C.split_retrieval_text(_composed(f).select("file_id", "chunk_index", "content"))
    return out.select("file_id", F.col("chunk_index").cast("long").alias("chunk_index"), "retrieval_text")


@query("pack_embed_batches", "chunks", """
WITH x AS (SELECT file_id, chunk_index AS i, least(length(content), 512) AS len FROM chunks),
w AS (SELECT file_id, i, 1 AS items, len AS chars, CAST(0 AS BIGINT) AS batch FROM x WHERE i = 0
 UNION ALL SELECT x.file_id, x.i, CASE WHEN w.items >= 8 OR w.chars + x.len > 2048 THEN 1 ELSE w.items + 1 END, CASE WHEN w.items >= 8 OR w.chars + x.len > 2048 THEN x.len ELSE w.chars + x.len END,
  CASE WHEN w.items >= 8 OR w.chars + x.len > 2048 THEN w.batch + 1 ELSE w.batch END FROM w JOIN x ON x.file_id = w.file_id AND x.i = w.i + 1)
SELECT file_id, i AS chunk_index, batch AS batch_id FROM w""", recursive=True)
def pack_embed_batches(f):
    out = C.pack_embed_batches(f.stored("chunks").select("file_id", "chunk_index", "content"))
    return out.select("file_id", F.col("chunk_index").cast("long").alias("chunk_index"), "batch_id")


@query("check_embeddings", "", "SELECT count(*) AS rows, count(embedding) AS present, count(*) AS long_enough, count(*) AS finite, count(*) FILTER (WHERE len(embedding) = 64) AS right_dimension, count(*) FILTER (WHERE len(embedding) = 64) AS valid FROM embeddings")
def check_embeddings(f):
    # vectors arrive as JSON text, every third one nested
    text = F.to_json("embedding")
    raw = F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return C.check_embeddings(f.embeddings.select(C.coerce_vector(raw).alias("embedding")), 64)


@query("replace_file_chunks", "chunks", """
SELECT file_id, 'old' AS kind, count(*) AS n FROM chunks WHERE doc_id % 4 <> 0 OR doc_id % 17 = 0 GROUP BY 1
UNION ALL SELECT file_id, 'new', count(*) FROM chunks WHERE doc_id % 4 = 0 AND doc_id % 17 <> 0 AND chunk_index % 2 = 0 GROUP BY 1""")
def replace_file_chunks(f):
    old = f.chunks.select("file_id", "content", "embedding", F.lit("old").alias("kind"))
    new = f.chunks.where("doc_id % 4 = 0 AND chunk_index % 2 = 0").select("file_id", "content", "embedding", F.lit("new").alias("kind"))
    return C.replace_file_chunks(old, new).groupBy("file_id", "kind").agg(F.count("*").alias("n"))


@query("backfill_targets", "chunks", "SELECT id, content AS retrieval_text FROM chunks WHERE embedding IS NOT NULL AND embedding_perguntas IS NULL")
def backfill_targets(f):
    return C.backfill_targets(f.chunks)


@query("mark_processed", "attachments chunks", f"WITH {_KEYED}, {_HEALTH} SELECT id, coalesce(fully_indexed, false) AS is_processed FROM ak LEFT JOIN hl ON ak.file_key = hl.file_id")
def mark_processed(f):
    return C.mark_processed(f.attachments, C.index_health(f.chunks)).select("id", "is_processed")


@query("summarize_processing", "attachments chunks", f"""WITH {_QUEUE}, {_HEALTH}
SELECT CAST(coalesce(sum(total),0) AS BIGINT) AS total_chunks, CAST(coalesce(sum(with_embedding),0) AS BIGINT) AS embeddings_ok, count(*) FILTER (WHERE NOT coalesce(fully_indexed,false)) AS pdf_failures,
 CASE WHEN count(*) FILTER (WHERE NOT coalesce(fully_indexed,false)) > 0 THEN 'warn' ELSE 'info' END AS severity FROM qu LEFT JOIN hl ON qu.file_key = hl.file_id""")
def summarize_processing(f):
    return C.summarize_processing(C.index_health(f.chunks), C.build_queue(f.attachments))
