"""Queries of the deadline group (2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import deadlines as D
from ..operators import deadlines as T
from .derived import AS_OF
from .registry import query

# deadline wording of every form, one per order
_Y, _M, _DAY = "CAST(year(o_orderdate) AS VARCHAR)", "lpad(CAST(month(o_orderdate) AS VARCHAR),2,'0')", "lpad(CAST(day(o_orderdate) AS VARCHAR),2,'0')"
_MONTHS = "['janeiro','fev','março','abril','mai','junho','julho','ago','setembro','outubro','nov','dezembro']"
_TEXTS = f"""tx AS (SELECT o_orderkey AS id, o_orderdate AS dt, o_orderkey % 8 AS form, CASE o_orderkey % 8
 WHEN 0 THEN 'Até o dia '||{_DAY}||'/'||{_M}||'/'||right({_Y},2) WHEN 1 THEN 'de 01/01/1992 a '||{_DAY}||'.'||{_M}||'.'||{_Y}||' e resultado em 15/12/1999'
 WHEN 2 THEN 'início 2 de março de 1993; fim: '||CAST(day(o_orderdate) AS VARCHAR)||' de '||{_MONTHS}[month(o_orderdate)]||' de '||{_Y}||' ou 30/12/1999'
 WHEN 3 THEN 'prazo '||CAST(day(o_orderdate) AS VARCHAR)||' '||{_MONTHS}[month(o_orderdate)]||' '||{_Y} WHEN 4 THEN '31/02/'||{_Y} WHEN 5 THEN {_Y}||'-'||{_M}||'-'||{_DAY}||'T23:59'
 WHEN 6 THEN 'sem data, fluxo contínuo' ELSE 'até 5/3/1991' END AS text FROM orders)"""


def _texts(f):
    k, dt = F.col("o_orderkey"), F.col("o_orderdate")
    names = F.array(*[F.lit(m) for m in ("janeiro", "fev", "março", "abril", "mai", "junho", "julho", "ago", "setembro", "outubro", "nov", "dezembro")])
    month = F.element_at(names, F.month(dt))
    day = F.day(dt)
    text = (
        F.when(k % 8 == 0, F.concat(F.lit("Até o dia "), F.date_format(dt, "dd/MM/yy")))
        .when(k % 8 == 1, F.concat(F.lit("de 01/01/1992 a "), F.date_format(dt, "dd.MM.yyyy"), F.lit(" e resultado em 15/12/1999")))
        .when(k % 8 == 2, F.concat(F.lit("início 2 de março de 1993; fim: "), day, F.lit(" de "), month, F.lit(" de "), F.year(dt), F.lit(" ou 30/12/1999")))
        .when(k % 8 == 3, F.concat(F.lit("prazo "), day, F.lit(" "), month, F.lit(" "), F.year(dt)))
        .when(k % 8 == 4, F.concat(F.lit("31/02/"), F.year(dt)))
        .when(k % 8 == 5, F.date_format(dt, "yyyy-MM-dd'T23:59'"))
        .when(k % 8 == 6, "sem data, fluxo contínuo")
        .otherwise("até 5/3/1991")
    )
    return f.orders.select(k.alias("id"), text.alias("text"))


_DS = "strftime(dt, '%Y-%m-%d')"
_BACK = "strftime(make_date(CAST(year(dt) AS INT), 2, 1) + to_days(30), '%Y-%m-%d')"
# an ISO date is also read as d-m-yy: 1998-03-05 gives 98-03-05, day 98 rolled over
_ODD = "strftime(make_date(2000 + CASE WHEN day(dt) <= 69 THEN CAST(day(dt) AS INT) ELSE 0 END, 1, 1) + to_months(CAST(month(dt) - 1 AS INT)) + to_days(CAST(year(dt) % 100 - 1 AS INT)), '%Y-%m-%d')"


@query("extract_dates", "", f"""WITH {_TEXTS},
m AS (SELECT id, CASE form WHEN 0 THEN [{_DS}] WHEN 1 THEN ['1992-01-01', {_DS}, '1999-12-15'] WHEN 2 THEN ['1999-12-30', '1993-03-02', {_DS}]
 WHEN 3 THEN [{_DS}] WHEN 4 THEN [{_BACK}] WHEN 5 THEN [{_DS}] WHEN 6 THEN [] ELSE ['1991-03-05'] END AS ds FROM tx)
SELECT id, unnest(ds) AS date FROM m""")
def extract_dates(f):
    return T.extract_dates(_texts(f), "text", "id").select("id", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("latest_date", "", f"""WITH {_TEXTS} SELECT id, CASE form WHEN 1 THEN greatest('1999-12-15', {_DS}) WHEN 2 THEN greatest('1999-12-30', {_DS}) WHEN 4 THEN {_BACK} WHEN 6 THEN NULL WHEN 7 THEN '1991-03-05' ELSE {_DS} END AS latest,
 CASE form WHEN 4 THEN {_BACK} WHEN 6 THEN NULL WHEN 7 THEN '1991-03-05' ELSE {_DS} END AS phase_deadline,
 CASE form WHEN 1 THEN greatest('1999-12-15', {_DS}) WHEN 2 THEN greatest('1999-12-30', {_DS}) WHEN 4 THEN {_BACK} WHEN 6 THEN NULL WHEN 7 THEN '1991-03-05' ELSE {_DS} END AS text_deadline FROM tx""")
def latest_date(f):
    out = T.latest_date(_texts(f), "text")
    return out.select("id", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("latest", "phase_deadline", "text_deadline")])


_YR = "left(data_publicacao, 4)"
_TL = f"""tl AS (SELECT *, CASE id % 4 WHEN 2 THEN data_publicacao WHEN 3 THEN data_publicacao END AS deadline,
 CASE id % 4 WHEN 2 THEN 'de 02/01/'||{_YR}||' até '||strftime(criado_em, '%d/%m/%Y') WHEN 3 THEN strftime(criado_em, '%d/%m/%Y') END AS phase_text,
 CASE id % 4 WHEN 2 THEN 'Submissão de propostas' WHEN 3 THEN 'Inscrições' END AS phase_name FROM notices)"""


@query("timeline_deadline", "notices", f"WITH {_TL} SELECT id, deadline, phase_text, phase_name FROM tl")
def timeline_deadline(f):
    out = T.timeline_deadline(f.notices.select("id", "timeline_estimada"))
    return out.select("id", F.date_format("deadline", "yyyy-MM-dd").alias("deadline"), "phase_text", "phase_name")


_DERIVED = f"""{_TL}, dv AS (SELECT *, CASE WHEN id % 4 = 2 THEN 'Até '||CASE WHEN strftime(criado_em, '%Y%m%d') >= {_YR}||'0102' THEN strftime(criado_em, '%d/%m/%Y') ELSE '02/01/'||{_YR} END
 WHEN id % 4 = 3 THEN 'Até '||strftime(criado_em, '%d/%m/%Y') WHEN id % 9 IN (0, 1) THEN NULL ELSE 'Até '||strftime(criado_em, '%d/%m/%Y') END AS derived FROM tl)"""


@query("derive_deadline", "notices", f"WITH {_DERIVED} SELECT id, derived FROM dv")
def derive_deadline(f):
    return T.derive_deadline(f.notices.select("id", "timeline_estimada", "data_encerramento")).select("id", "derived")


@query("normalize_deadline", "", f"""WITH {_TEXTS} SELECT id, CASE form WHEN 0 THEN 'Até '||strftime(dt, '%d/%m/%y') WHEN 1 THEN 'Até '||strftime(greatest(DATE '1999-12-15', CAST(dt AS DATE)), '%d/%m/%Y') WHEN 2 THEN 'Até '||strftime(greatest(DATE '1999-12-30', CAST(dt AS DATE)), '%d/%m/%Y') WHEN 4 THEN 'Até '||strftime(make_date(CAST(year(dt) AS INT), 2, 1) + to_days(30), '%d/%m/%Y')
 WHEN 6 THEN text WHEN 7 THEN 'Até 05/03/1991' ELSE 'Até '||strftime(dt, '%d/%m/%Y') END AS normalized FROM tx""")
def normalize_deadline(f):
    return T.normalize_deadline(_texts(f), "text").select("id", "normalized")


# the ISO form also looks like a two-digit year unless letters follow, and reads as such a date too
_NORM = """CASE id % 6 WHEN 2 THEN 'Até '||strftime(criado_em, '%d/%m/%Y') WHEN 3 THEN 'Até '||strftime(criado_em, '%d/%m/%Y')
 WHEN 4 THEN 'Até '||strftime(greatest(CAST(criado_em AS DATE), odd), '%d/%m/%y') WHEN 5 THEN 'consulte o portal' END"""
_ODD_DATE = "CAST(make_date(CASE WHEN day(criado_em) <= 69 THEN 2000 + CAST(day(criado_em) AS INT) ELSE 1900 END, 1, 1) + to_months(CAST(month(criado_em) - 1 AS INT)) + to_days(CAST(year(criado_em) % 100 - 1 AS INT)) AS DATE)"
_RECON = f"""{_DERIVED}, rc AS (SELECT *, CASE WHEN id % 6 IN (0, 1) THEN derived ELSE {_NORM} END AS reconciled FROM (SELECT *, {_ODD_DATE} AS odd FROM dv) o)"""


@query("reconcile_deadline", "notices", f"WITH {_RECON} SELECT id, reconciled, reconciled IS NOT NULL AND (prazo_inscricao IS NULL OR reconciled <> prazo_inscricao) AS changed FROM rc")
def reconcile_deadline(f):
    return T.reconcile_deadline(f.notices).select("id", "reconciled", "changed")


@query("collect_deadlines", "notices", f"""WITH {_TL}, c AS (SELECT id, deadline AS d1, CASE WHEN id % 6 IN (2, 3) THEN data_publicacao WHEN id % 6 = 4 THEN strftime(greatest(CAST(criado_em AS DATE), {_ODD_DATE}), '%Y-%m-%d') END AS d2,
 CASE WHEN id % 9 NOT IN (0, 1) THEN CASE WHEN id % 9 = 3 THEN data_publicacao ELSE data_publicacao END END AS d3 FROM tl)
SELECT id, array_to_string(list_filter([d1, d2, d3], lambda x: x IS NOT NULL AND x >= '1995'), ',') AS deadlines FROM c""")
def collect_deadlines(f):
    out = T.collect_deadlines(f.notices, plausible_from=1995)
    return out.select("id", F.array_join(F.transform("deadlines", lambda x: F.date_format(x, "yyyy-MM-dd")), ",").alias("deadlines"))


_PATS = "|".join(D.active_patterns(AS_OF))


@query("active_patterns", "notices", """
WITH m AS (SELECT range AS m FROM range(8, 13)), p AS (SELECT lpad(CAST(m AS VARCHAR),2,'0')||'/1998' AS pattern FROM m UNION SELECT CAST(m AS VARCHAR)||'/1998' FROM m UNION SELECT CAST(y.range AS VARCHAR) FROM range(1999, 2003) y)
SELECT pattern, count(n.id) AS notices FROM p LEFT JOIN notices n ON contains(coalesce(n.data_encerramento,''), pattern) GROUP BY 1""")
def active_patterns(f):
    # how many closing dates carry each pattern: one pass, patterns as an array, no join over notices
    pats = F.array(*[F.lit(p) for p in D.active_patterns(AS_OF)])
    n = f.notices.select(F.explode(F.filter(pats, lambda p: F.contains(F.coalesce("data_encerramento", F.lit("")), p))).alias("pattern"))
    counts = n.groupBy("pattern").agg(F.count("*").alias("notices"))
    return T.active_patterns(f.spark, AS_OF).join(counts, "pattern", "left").na.fill(0, ["notices"])


_TEXT = "lower(concat_ws(' ', nullif(titulo,''), nullif(descricao,''), nullif(sobre_programa,''), nullif(numero,''), nullif(prazo_inscricao,''), nullif(data_encerramento,''), nullif(timeline_estimada,'')))"
_ACT = f"regexp_matches({_TEXT}, '(^|[^0-9])({_PATS})([^0-9]|$)')"


@query("match_active_text", "notices", f"SELECT id, {_ACT} AS active_text FROM notices")
def match_active_text(f):
    return T.match_active_text(f.notices, AS_OF).select("id", "active_text")


# prazo dates, then the closing date if it is a whole date
@query("active_notices", "notices", f"""WITH a AS (SELECT *, {_ACT} AS at_, greatest(CASE WHEN id % 6 IN (2, 4) THEN CAST(criado_em AS DATE) WHEN id % 6 = 3 THEN greatest(CAST(criado_em AS DATE), make_date(CAST(year(criado_em) AS INT), 1, 1)) END,
 CASE WHEN id % 9 IN (0, 1, 2) THEN NULL ELSE CAST(criado_em AS DATE) END) AS st FROM notices)
SELECT id, CASE WHEN lower(status) = 'encerrado' THEN false WHEN st IS NOT NULL THEN st >= DATE '{AS_OF}' ELSE at_ OR (id % 4 IN (2, 3) AND criado_em >= DATE '1998-08-01') OR (id % 4 = 3 AND year(criado_em) >= 1998) OR (id % 4 = 2 AND year(criado_em) > 1998) END AS active FROM a""")
def active_notices(f):
    return T.active_notices(f.notices, AS_OF).select("id", "active")
