"""Queries of the recommendation and account group (2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recommend as R
from .derived import AS_OF
from .registry import query

USES = "requests profiles companies catalogue"


def _scope_sql(legacy: bool = False) -> str:
    kind = "coalesce(p.user_type, 'pesquisador')"
    if not legacy:
        kind = f"CASE WHEN r.empresa_id IS NOT NULL OR {kind} IN ('pessoa-empresa','ambos') THEN 'consultor' ELSE {kind} END"
    return f"""sc0 AS (SELECT r.user_id, r.empresa_id, {kind} AS user_type, CASE WHEN r.empresa_id IS NOT NULL THEN coalesce(nullif(trim(c.area),''), p.area, '') ELSE coalesce(p.area,'') END AS area,
 greatest(1, least(coalesce(p_limit, 20), 50)) AS v_limit, r.empresa_id IS NULL OR c.id IS NOT NULL AS ok FROM requests r LEFT JOIN profiles p ON p.user_id = r.user_id LEFT JOIN companies c ON c.id = r.empresa_id AND c.owner_user_id = r.user_id),
sc AS (SELECT * FROM sc0 WHERE ok)"""


_RECENT = "rc AS (SELECT * FROM catalogue ORDER BY validado_em DESC NULLS LAST, criado_em DESC NULLS LAST, id LIMIT 500)"


def _pairs_sql(legacy: bool = False) -> str:
    hit = "area <> '' AND hay LIKE '%'||lower(area)||'%' ESCAPE '\\'"
    comp = "pessoa-empresa" if legacy else "consultor"
    both = " WHEN user_type = 'ambos' AND (is_researcher OR is_company) THEN 35" if legacy else ""
    both_r = " WHEN user_type = 'ambos' AND (is_researcher OR is_company) THEN 'Compatível com seu tipo de perfil'" if legacy else ""
    area_r = "'Área alinhada ao seu perfil'" if legacy else "CASE WHEN empresa_id IS NOT NULL THEN 'Área alinhada à empresa' ELSE 'Área alinhada ao seu perfil' END"
    return f"""{_scope_sql(legacy)}, ps AS (SELECT user_id, empresa_id, v_limit, id AS edital_id, greatest(0, least(100, 10
 + CASE WHEN user_type = 'pesquisador' AND is_researcher THEN 45 WHEN user_type = 'pesquisador' AND NOT is_researcher THEN -50 WHEN user_type = '{comp}' AND is_company THEN 45 WHEN user_type = '{comp}' AND NOT is_company THEN -50{both} ELSE 0 END
 + CASE WHEN {hit} THEN 25 ELSE 0 END + CASE WHEN data_encerramento IS NULL THEN 5 WHEN CAST(data_encerramento AS DATE) >= DATE '{AS_OF}' THEN 15 ELSE -35 END
 + CASE WHEN valor_projeto IS NOT NULL OR valor IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN sobre_programa IS NOT NULL OR criterios_elegibilidade IS NOT NULL THEN 5 ELSE 0 END)) AS score,
 concat_ws(';', CASE WHEN user_type = 'pesquisador' AND is_researcher THEN 'Elegível para pesquisadores/ICTs' WHEN user_type = '{comp}' AND is_company THEN 'Elegível para empresas/startups'{both_r} END, CASE WHEN {hit} THEN {area_r} END,
  CASE WHEN data_encerramento IS NULL THEN 'Prazo não identificado automaticamente' WHEN CAST(data_encerramento AS DATE) >= DATE '{AS_OF}' THEN 'Prazo ainda aberto' ELSE 'Prazo possivelmente encerrado' END,
  CASE WHEN valor_projeto IS NOT NULL OR valor IS NOT NULL THEN 'Possui informação de valor/financiamento' END) AS motivos
 FROM sc CROSS JOIN (SELECT id, is_researcher, is_company, data_encerramento, valor_projeto, valor, sobre_programa, criterios_elegibilidade, lower(coalesce(area,'')||' '||coalesce(titulo,'')||' '||coalesce(descricao,'')||' '||coalesce(sobre_programa,'')) AS hay FROM catalogue) n),
tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, empresa_id ORDER BY score DESC, edital_id) AS rank FROM ps WHERE score >= 25) t WHERE rank <= v_limit)"""


def _scopes(f, legacy=False):
    return R.resolve_scopes(f.requests, f.profiles, f.companies, legacy)


def _scoring(f, legacy=False):
    return R.Scoring(_scopes(f, legacy)[0], f.catalogue, AS_OF, legacy)


def _top(f):
    return R.top_recommendations(_scoring(f))


@query("resolve_scopes", USES, f"WITH {_scope_sql()} SELECT user_id, empresa_id, user_type, area, CAST(v_limit AS INT) AS v_limit FROM sc")
def resolve_scopes(f):
    return _scopes(f)[0]


@query("resolve_scopes_rejected", USES, f"WITH {_scope_sql()} SELECT user_id, empresa_id FROM sc0 WHERE NOT ok")
def resolve_scopes_rejected(f):
    return _scopes(f)[1]


_SUMS = "user_id, empresa_id, count(*) AS notices, CAST(sum(score) AS BIGINT) AS total, CAST(max(score) AS BIGINT) AS best, count(*) FILTER (WHERE score >= 25) AS eligible"


@query("score_notices", USES, f"WITH {_pairs_sql()} SELECT {_SUMS} FROM ps GROUP BY 1, 2")
def score_notices(f):
    return R.score_notices(_scoring(f))


@query("legacy_audience_score", USES, f"WITH {_pairs_sql(True)} SELECT {_SUMS} FROM ps GROUP BY 1, 2")
def legacy_audience_score(f):
    return R.score_notices(_scoring(f, True))


@query("score_reasons", USES, f"WITH {_pairs_sql()} SELECT user_id, empresa_id, edital_id, motivos FROM tp")
def score_reasons(f):
    return _top(f).select("user_id", "empresa_id", "edital_id", F.array_join("motivos", ";").alias("motivos"))


@query("recent_500", "catalogue", f"WITH {_RECENT} SELECT id, validado_em IS NULL AS unvalidated FROM rc")
def recent_500(f):
    return R.recent_notices(f.catalogue).select("id", F.col("validado_em").isNull().alias("unvalidated"))


@query("top_recommendations", USES, f"WITH {_pairs_sql()} SELECT user_id, empresa_id, rank, edital_id, CAST(score AS BIGINT) AS score FROM tp")
def top_recommendations(f):
    out = _top(f)
    return out.select("user_id", "empresa_id", F.col("rank").cast("long").alias("rank"), "edital_id", F.col("score").cast("long").alias("score"))


# stored rows: one old notice for every request, and one for users no request names
_STORED = "so AS (SELECT user_id, empresa_id, CAST(-1 AS BIGINT) AS edital_id, 50 AS score FROM requests UNION ALL SELECT user_id + 900000000, NULL, -2, 60 FROM profiles)"


def _stored(f):
    old = f.requests.select("user_id", "empresa_id", F.lit(-1).cast("long").alias("edital_id"), F.lit(50).alias("score"))
    other = f.profiles.select((F.col("user_id") + 900000000).alias("user_id"), F.lit(None).cast("long").alias("empresa_id"), F.lit(-2).cast("long").alias("edital_id"), F.lit(60).alias("score"))
    return old.unionByName(other)


@query("replace_scope_rows", USES, f"""WITH {_pairs_sql()}, {_STORED}
SELECT user_id, empresa_id, edital_id, CAST(score AS BIGINT) AS score FROM so WHERE NOT EXISTS (SELECT 1 FROM sc WHERE sc.user_id = so.user_id AND sc.empresa_id IS NOT DISTINCT FROM so.empresa_id)
UNION ALL SELECT user_id, empresa_id, edital_id, CAST(score AS BIGINT) FROM tp""")
def replace_scope_rows(f):
    new = _top(f).select("user_id", "empresa_id", "edital_id", "score")
    snapshot, _ = R.replace_scope_rows(_stored(f), new, _scopes(f)[0].select("user_id", "empresa_id"))
    return snapshot.withColumn("score", F.col("score").cast("long"))


@query("upsert_scope_rows", USES, f"""WITH {_pairs_sql()}, nw AS (SELECT user_id, edital_id, score FROM tp WHERE empresa_id IS NULL AND edital_id % 3 <> 0),
od AS (SELECT user_id, edital_id, 1 AS score FROM tp WHERE empresa_id IS NULL AND edital_id % 2 = 0 UNION ALL SELECT user_id, -2, 60 FROM profiles)
SELECT user_id, edital_id, CAST(score AS BIGINT) AS score, false AS updated FROM od WHERE NOT EXISTS (SELECT 1 FROM nw WHERE nw.user_id = od.user_id AND nw.edital_id = od.edital_id)
UNION ALL SELECT user_id, edital_id, CAST(score AS BIGINT), true FROM nw""")
def upsert_scope_rows(f):
    best = f.stored("best", lambda: _top(f).where("empresa_id IS NULL").select("user_id", "edital_id", F.col("score").cast("long").alias("score")))
    old = best.where("edital_id % 2 = 0").withColumn("score", F.lit(1).cast("long"))
    old = old.unionByName(f.profiles.select("user_id", F.lit(-2).cast("long").alias("edital_id"), F.lit(60).cast("long").alias("score")))
    new = best.where("edital_id % 3 <> 0")
    return R.upsert_scope_rows(old.withColumn("updated", F.lit(False)), new.withColumn("updated", F.lit(True)))


@query("backfill_companies", "profiles companies", """SELECT user_id AS owner_user_id, trim(cnpj) AS razao_social, regexp_replace(cnpj, '[^0-9]', '', 'g') AS cnpj, area FROM profiles p
WHERE user_type = 'consultor' AND has_cnpj AND cnpj IS NOT NULL AND NOT EXISTS (SELECT 1 FROM companies c WHERE c.owner_user_id = p.user_id AND c.cnpj = regexp_replace(p.cnpj, '[^0-9]', '', 'g'))""")
def backfill_companies(f):
    return R.backfill_companies(f.profiles, f.companies).drop("dados")


@query("remap_user_types", "profiles", "SELECT user_id, CASE WHEN user_type = 'ambos' THEN 'consultor' ELSE user_type END AS user_type, true AS valid FROM profiles")
def remap_user_types(f):
    return R.remap_user_types(f.profiles).select("user_id", "user_type", "valid")


@query("propagate_company", "proposals projects", "SELECT p.id, coalesce(p.empresa_id, j.empresa_id) AS empresa_id FROM proposals p LEFT JOIN projects j ON j.id = p.projeto_id")
def propagate_company(f):
    return R.propagate_company(f.proposals, f.projects).select("id", "empresa_id")


@query("check_constraints", "proposals projects companies", """
WITH rec AS (SELECT projeto_id % 500 AS user_id, empresa_id, id % 40 AS edital_id FROM proposals), co AS (SELECT floor(id / 5) AS owner_user_id, CASE WHEN cnpj = '' THEN '' ELSE left(cnpj, 13) END AS cnpj FROM companies)
SELECT 'recommendation_user' AS rule, CAST(user_id AS VARCHAR)||'/'||CAST(edital_id AS VARCHAR) AS key, count(*) AS n FROM rec WHERE empresa_id IS NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'recommendation_company', CAST(user_id AS VARCHAR)||'/'||CAST(empresa_id AS VARCHAR)||'/'||CAST(edital_id AS VARCHAR), count(*) FROM rec WHERE empresa_id IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'company_tax_id', CAST(CAST(owner_user_id AS BIGINT) AS VARCHAR)||'/'||cnpj, count(*) FROM co WHERE cnpj <> '' GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'project_audience', CAST(id AS VARCHAR), 1 FROM projects WHERE publico_alvo = 'todos' UNION ALL SELECT 'project_state', CAST(id AS VARCHAR), 1 FROM projects WHERE status = 'x'
UNION ALL SELECT 'project_states_of_country', CAST(id AS VARCHAR), 1 FROM projects WHERE uf_form = 1""")
def check_constraints(f):
    rec = f.proposals.select((F.col("projeto_id") % 500).alias("user_id"), "empresa_id", (F.col("id") % 40).alias("edital_id"))
    co = f.companies.select(F.floor(F.col("id") / 5).alias("owner_user_id"), F.when(F.col("cnpj") == "", "").otherwise(F.substring("cnpj", 1, 13)).alias("cnpj"))
    ufs = F.when(F.col("uf_form") == 0, F.lit(None).cast("array<string>")).when(F.col("uf_form") == 1, F.array(F.lit("SP"), F.lit("XX"))).otherwise(F.array(F.lit("SP"), F.lit("RJ")))
    return R.check_constraints(rec, co, f.projects.withColumn("abrangencia_ufs", ufs))
