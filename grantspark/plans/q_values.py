"""Queries of the money group (2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import values as V
from . import duck as d
from .registry import query

_N = "(CAST(floor(o_totalprice) AS BIGINT) % 900 + 100)"
# value wording of every form, one per order; the same SQL in both engines
VALUE_TEXTS = f"""SELECT o_orderkey AS id, o_orderkey % 10 AS form, {_N} AS n, CASE o_orderkey % 10
 WHEN 0 THEN 'R$ '||CAST({_N} AS STRING)||'.000,00 (quinhentos mil reais)' WHEN 1 THEN 'valor global R$ '||CAST({_N} AS STRING)||' milhões' WHEN 2 THEN 'R$ 1,5 milhão'
 WHEN 3 THEN 'R$ 1500,00' WHEN 4 THEN 'até R$ 100.000,00 e R$ '||CAST({_N} AS STRING)||'.000,50 por projeto' WHEN 5 THEN CAST({_N} AS STRING)||' mil reais'
 WHEN 6 THEN '000'||CAST(o_orderkey AS STRING)||' / 1998' WHEN 7 THEN 'bolsa (dois milhões e quinhentos mil reais)' WHEN 8 THEN '10/03/1998'
 ELSE 'Faixa A R$ 10.000,00; Faixa B R$ '||CAST({_N} AS STRING)||'.000,00 (x)' END AS text, CAST(o_orderkey AS STRING)||'/1998' AS numero FROM orders"""
_VT = f"vt AS ({VALUE_TEXTS})"


def _texts(f):
    return f.spark.sql(VALUE_TEXTS.replace("FROM orders", "FROM {orders}"), orders=f.orders)


@query("extract_amounts", "", f"""WITH {_VT}, a AS (SELECT id, CASE form WHEN 0 THEN CASE WHEN abs(n*1000.0 - 500000) / greatest(n*1000.0, 500000) < 0.01 THEN [n*1000.0] ELSE [n*1000.0, 500000] END WHEN 1 THEN [n, n*1e6] WHEN 2 THEN [1, 1500000]
 WHEN 3 THEN [150] WHEN 4 THEN [100000, n*1000.0+0.5] WHEN 5 THEN [n*1000.0] WHEN 7 THEN [2500000] WHEN 9 THEN [10000, n*1000.0] ELSE [] END AS l FROM vt)
SELECT id, CAST(unnest(l) AS DOUBLE) AS amount FROM a""")
def extract_amounts(f):
    return V.extract_amounts(_texts(f), "text", "id").drop("n")


_HUN = ("cento", "duzentos", "trezentos", "quatrocentos", "quinhentos", "seiscentos", "setecentos", "oitocentos", "novecentos")
_TEN = ("vinte", "trinta", "quarenta", "cinquenta", "sessenta", "setenta", "oitenta", "noventa")


@query("parse_written_numbers", "", """SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 9 + 1) * 1000000 + ((o_orderkey % 8 + 2) * 10 + 3) * 1000 + (o_orderkey % 7 + 1) * 100 END AS DOUBLE) AS amount FROM orders""")
def parse_written_numbers(f):
    k = F.col("o_orderkey")
    units = F.array(*[F.lit(w) for w in ("um", "dois", "três", "quatro", "cinco", "seis", "sete", "oito", "nove")])
    text = F.concat(
        F.element_at(units, (k % 9 + 1).cast("int")), F.when(k % 9 == 0, " milhão, ").otherwise(" Milhões, "),
        F.element_at(F.array(*[F.lit(w) for w in _TEN]), (k % 8 + 1).cast("int")), F.lit(" e três mil e "),
        F.element_at(F.array(*[F.lit(w) for w in _HUN]), (k % 7 + 1).cast("int")), F.lit(" reais"),
    )
    rows = f.orders.select(k.alias("id"), F.when(k % 5 == 0, "duzentos reais").otherwise(text).alias("text"))
    return V.parse_written_numbers(rows, "text").select("id", "amount")


@query("value_lines", "", f"""WITH {_VT} SELECT id, CASE form WHEN 0 THEN 'R$ '||CAST(n AS VARCHAR)||'.000,00' WHEN 4 THEN 'até R$ 100.000,00|R$ '||CAST(n AS VARCHAR)||'.000,50 por projeto' WHEN 7 THEN 'bolsa'
 WHEN 9 THEN 'R$ 10.000,00; Faixa B|R$ '||CAST(n AS VARCHAR)||'.000,00' ELSE text END AS lines FROM vt""")
def value_lines(f):
    return V.value_lines(_texts(f), "text").select("id", F.array_join("lines", "|").alias("lines"))


_STORED = """SELECT id, n, form, numero, text, CASE id % 5 WHEN 0 THEN '{"valor":["até R$ '||CAST(n AS STRING)||'.000,00"," R$ 5,00 ","null"],"bolsas":["bolsa R$ 900,00"],"por_projeto_origem":null,"total_programa_texto":"R$ 9 milhões total"}'
 WHEN 1 THEN '{"valor":["'||text||'","segunda  linha"]}' WHEN 2 THEN '{"valor":[{"valor":"'||text||'"}]}' WHEN 3 THEN '{"valor":"'||text||'"}' ELSE '  '||text||' ' END AS valor_projeto FROM vt"""


def _stored(f):
    sql = _STORED.replace("{", "{{").replace("}", "}}").replace("FROM vt", "FROM {vt}")
    return f.spark.sql(sql, vt=_texts(f))


_FLAT = f"""{_VT}, sv AS ({_STORED}), fl AS (SELECT *, CASE id % 5 WHEN 0 THEN ['até R$ '||CAST(n AS VARCHAR)||'.000,00', 'R$ 5,00', 'bolsa R$ 900,00', 'R$ 9 milhões total'] WHEN 1 THEN [text, 'segunda linha'] ELSE [text] END AS lines FROM sv)"""


@query("flatten_value", "", f"WITH {_FLAT} SELECT id, array_to_string(lines, '|') AS lines FROM fl")
def flatten_value(f):
    return V.flatten_value(_stored(f)).select("id", F.array_join("lines", "|").alias("lines"))


# forms 6 (its own number) and 8 (a bare date) are no money; everything else carries an amount or a word
_QUAL = f"""{_FLAT}, ql AS (SELECT *, id % 5 <> 0 AND form = 6 AS matches_number, id % 5 <> 0 AND form IN (6, 8) AS any_invalid, id % 5 = 0 OR form NOT IN (6, 8) AS any_money FROM fl)"""


@query("value_quality", "", f"WITH {_QUAL} SELECT id, matches_number, any_invalid, any_money, matches_number OR any_invalid OR NOT any_money AS suspicious, NOT (matches_number OR any_invalid OR NOT any_money) AS plausible FROM ql")
def value_quality(f):
    return V.value_quality(_stored(f)).select("id", "matches_number", "any_invalid", "any_money", "suspicious", "plausible")


@query("value_acceptance", "", f"WITH {_QUAL} SELECT id, CASE WHEN any_invalid THEN CASE WHEN len(lines) = 1 THEN 'reject' ELSE 'check' END WHEN id % 5 = 1 THEN 'check' ELSE 'accept' END AS verdict FROM ql")
def value_acceptance(f):
    return V.value_acceptance(_stored(f)).select("id", "verdict")


# model answers: per-project and total separated, mixed up, repeated, unsupported, single project
ANSWERS = """SELECT id, n, id % 6 AS form, CASE id % 6
 WHEN 0 THEN '{"por_projeto":["até R$ '||CAST(n AS STRING)||'.000,00 por proposta"],"por_projeto_min":50000,"total_programa":"R$ 10.000.000,00 (valor global)","qtd_projetos":20,"bolsas":["bolsa R$ 3.000,00/mês","R$ 3.000,00"]}'
 WHEN 1 THEN '{"por_projeto":["Recursos totais R$ '||CAST(n AS STRING)||'.000,00","R$ 1.200,00 mensais"],"bolsas":[]}'
 WHEN 2 THEN '{"por_projeto":["R$ '||CAST(n AS STRING)||'.000,00"],"total_programa":'||CAST(n * 1000 AS STRING)||',"qtd_projetos":null}'
 WHEN 3 THEN '{"por_projeto":[],"total_programa":"R$ '||CAST(n AS STRING)||'.000,00","qtd_projetos":1}'
 WHEN 4 THEN '{"por_projeto":["R$ 77.777,00","de R$ 10.000,00 a R$ '||CAST(n AS STRING)||'.000,00"]}' ELSE '{"por_projeto":[],"bolsas":["bolsa a definir"]}' END AS raw,
 'Edital: R$ '||CAST(n AS STRING)||'.000,00; R$ 10.000.000,00; R$ 3.000,00; R$ 1.200,00; R$ 10.000,00; R$ 50.000,00' AS contexto FROM vt"""


def _answers(f):
    return f.spark.sql(ANSWERS.replace("{", "{{").replace("}", "}}").replace("FROM vt", "FROM {vt}"), vt=_texts(f))


# the foreign amount 77.777 is not in the context unless it is near n thousand
_STRUCT = f"""{_VT}, aw AS ({ANSWERS}), se AS (SELECT *, 'R$ '||CAST(n AS VARCHAR)||'.000,00' AS m FROM aw),
es AS (SELECT id, n, form, CASE form WHEN 0 THEN 'até '||m||' por proposta' WHEN 3 THEN 'até R$'||chr(160)||CAST(n AS VARCHAR)||'.000,00 (projeto único apoiado pela chamada)' WHEN 4 THEN 'de R$ 10.000,00 a '||m ELSE '' END AS valor,
 CASE form WHEN 0 THEN 'bolsa R$ 3.000,00/mês' WHEN 1 THEN 'R$ 1.200,00 mensais' ELSE '' END AS bolsas, CASE form WHEN 0 THEN 50000.0 WHEN 4 THEN 10000.0 END AS lo,
 CASE form WHEN 0 THEN n*1000.0 WHEN 3 THEN n*1000.0 WHEN 4 THEN n*1000.0 END AS hi, CASE form WHEN 0 THEN 'edital' WHEN 3 THEN 'projeto_unico' WHEN 4 THEN 'edital' END AS origem,
 CASE form WHEN 0 THEN 10000000.0 WHEN 1 THEN n*1000.0 WHEN 2 THEN n*1000.0 WHEN 3 THEN n*1000.0 END AS total,
 CASE form WHEN 0 THEN 'R$ 10.000.000,00 (valor global)' WHEN 1 THEN 'Recursos totais '||m WHEN 2 THEN 'R$'||chr(160)||CAST(n AS VARCHAR)||'.000,00' WHEN 3 THEN m END AS total_texto,
 CASE form WHEN 0 THEN 20 WHEN 3 THEN 1 END AS qtd, form = 5 AS nothing FROM se)"""
_SHOW = ("valor", "bolsas", "lo", "hi", "origem", "total", "total_texto", "qtd")


def _shown(df, *keys):
    e = "estruturado"
    return df.select(
        *keys, F.array_join(f"{e}.valor", "|").alias("valor"), F.array_join(f"{e}.bolsas", "|").alias("bolsas"), F.col(f"{e}.por_projeto_min").alias("lo"),
        F.col(f"{e}.por_projeto_max").alias("hi"), F.col(f"{e}.por_projeto_origem").alias("origem"), F.col(f"{e}.total_programa").alias("total"),
        F.col(f"{e}.total_programa_texto").alias("total_texto"), F.col(f"{e}.qtd_projetos").cast("long").alias("qtd"),
    )


_SEL = ", ".join(f"CASE WHEN NOT nothing THEN {'CAST(' + c + ' AS BIGINT)' if c == 'qtd' else 'CAST(' + c + ' AS DOUBLE)' if c in ('lo', 'hi', 'total') else c} END AS {c}" for c in _SHOW)


@query("structure_value", "", f"WITH {_STRUCT} SELECT id, {_SEL} FROM es")
def structure_value(f):
    return _shown(V.structure_value(_answers(f)), "id")


@query("merge_values", "", f"""WITH {_STRUCT}, g AS (SELECT *, CAST(floor(id / 7) AS BIGINT) AS k FROM es WHERE NOT nothing),
bo AS (SELECT k, string_agg(bolsas, '|' ORDER BY o) AS bolsas FROM (SELECT k, bolsas, min(id) AS o FROM g WHERE bolsas <> '' GROUP BY 1, 2) t GROUP BY 1)
SELECT g.k, coalesce(arg_min(valor, id) FILTER (WHERE valor <> ''), '') AS valor, coalesce(any_value(bo.bolsas), '') AS bolsas, arg_min(coalesce(lo, -1), id) FILTER (WHERE valor <> '') AS lo,
 CAST(arg_min(hi, id) FILTER (WHERE valor <> '') AS DOUBLE) AS hi, arg_min(origem, id) FILTER (WHERE valor <> '') AS origem, CAST(arg_min(total, id) FILTER (WHERE total_texto IS NOT NULL) AS DOUBLE) AS total,
 arg_min(total_texto, id) FILTER (WHERE total_texto IS NOT NULL) AS total_texto, CAST(arg_min(qtd, id) FILTER (WHERE qtd IS NOT NULL) AS BIGINT) AS qtd FROM g LEFT JOIN bo ON bo.k = g.k GROUP BY g.k""")
def merge_values(f):
    rows = V.structure_value(_answers(f)).withColumn("k", F.floor(F.col("id") / 7))
    out = _shown(V.merge_values(rows, ["k"], "id"), "k")
    return out.withColumn("lo", F.when(F.col("origem").isNotNull(), F.coalesce("lo", F.lit(-1.0))))


@query("compact_value", "", f"""WITH {_FLAT} SELECT id, CASE id % 5 WHEN 0 THEN '{{"valor":["'||lines[1]||'","R$ 5,00"],"bolsas":["bolsa R$ 900,00"],"por_projeto_min":null,"por_projeto_max":null,"por_projeto_origem":null,"total_programa":null,"total_programa_texto":"R$ 9 milhões total","qtd_projetos":null}}'
 WHEN 1 THEN '{{"valor":["'||text||'","segunda linha"]}}' WHEN 2 THEN '{{"valor":["'||text||'"]}}' WHEN 3 THEN '{{"valor":["'||text||'"]}}'
 ELSE CASE form WHEN 4 THEN '{{"valor":["até R$ 100.000,00","R$ '||CAST(n AS VARCHAR)||'.000,50 por projeto"]}}' WHEN 9 THEN '{{"valor":["R$ 10.000,00; Faixa B","R$ '||CAST(n AS VARCHAR)||'.000,00"]}}' ELSE text END END AS compacted FROM fl""")
def compact_value(f):
    return V.compact_value(_stored(f)).select("id", "compacted")


@query("reextract_candidates", "notices attachments", f"""SELECT id FROM notices WHERE valor_projeto IS NOT NULL AND id IN (SELECT edital_id FROM attachments WHERE is_processed) AND {d.has('valor_projeto', V.TOTAL_HINT)} AND id % 10 < 4""")
def reextract_candidates(f):
    return V.reextract_candidates(f.notices, f.attachments, f.notices.where("id % 10 < 4"), only_totals=True).select("id")
