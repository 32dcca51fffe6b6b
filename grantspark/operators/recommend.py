"""Recommendations of notices for all users and companies at once, and account data."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.deadlines import loose_date
from ..functions.text import blank, none_if_blank
from ..session import materialize

#: Characters of an index entry, and parts of a hot group.
GRAM, SALTS = 3, 16

# Legacy user types, reasons shown to the user, and allowed domains.
LEGACY_COMPANY_TYPES = ("pessoa-empresa", "ambos")
REASON_RESEARCH = "Elegível para pesquisadores/ICTs"
REASON_COMPANY = "Elegível para empresas/startups"
REASON_BOTH = "Compatível com seu tipo de perfil"
REASON_AREA_COMPANY = "Área alinhada à empresa"
REASON_AREA_PROFILE = "Área alinhada ao seu perfil"
REASON_NO_DEADLINE = "Prazo não identificado automaticamente"
REASON_OPEN = "Prazo ainda aberto"
REASON_CLOSED = "Prazo possivelmente encerrado"
REASON_VALUE = "Possui informação de valor/financiamento"
USER_TYPES = ("pesquisador", "consultor")
AUDIENCES = ("pesquisador", "empresa", "ambos")
PROJECT_STATES = ("rascunho", "ativo", "arquivado")
STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)


def remapped_type(user_type: Column | str) -> Column:
    t = F.col(user_type) if isinstance(user_type, str) else user_type
    return F.when(t.isin(*LEGACY_COMPANY_TYPES), "consultor").otherwise(t)


def resolve_scopes(requests: DataFrame, profiles: DataFrame, companies: DataFrame, legacy: bool = False, most: int | None = 50, default: int | None = 20) -> tuple[DataFrame, DataFrame]:
    """Requests (user_id, empresa_id, p_limit) to scopes with type, area and limit; and the rejected ones.

    A company request counts only for its owner. A missing profile reads as a researcher without area. Limits are
    brought into 1 to ``most`` (None: no upper end); a request without one gets ``default`` (None: all there are).
    """
    prof = profiles.groupBy("user_id").agg(F.min_by(F.struct("user_type", "area"), F.struct(F.coalesce("user_type", F.lit("")), F.coalesce("area", F.lit("")))).alias("p"))
    r = requests.join(prof, "user_id", "left")
    own = companies.select(F.col("id").alias("empresa_id"), F.col("owner_user_id").alias("user_id"), F.col("area").alias("c_area"), F.lit(True).alias("owned"))
    r = r.join(own, ["empresa_id", "user_id"], "left")
    kind = F.coalesce("p.user_type", F.lit("pesquisador"))
    kind = kind if legacy else F.when(F.col("empresa_id").isNotNull(), "consultor").otherwise(remapped_type(kind))
    area = F.coalesce("p.area", F.lit(""))
    area = F.when(F.col("empresa_id").isNotNull(), F.coalesce(none_if_blank(F.trim("c_area")), area)).otherwise(area)
    limit = F.coalesce("p_limit", F.lit(default).cast("int"))
    r = r.select(
        "user_id", "empresa_id", kind.alias("user_type"), area.alias("area"),
        F.when(limit.isNotNull(), F.greatest(F.lit(1), limit if most is None else F.least(limit, F.lit(most)))).alias("v_limit"),
        (F.col("empresa_id").isNull() | F.coalesce("owned", F.lit(False))).alias("ok"),
    )
    return r.where("ok").drop("ok"), r.where("NOT ok").select("user_id", "empresa_id")


def recent_notices(catalogue: DataFrame, n: int = 500) -> DataFrame:
    """The newest validated notices (M04); recommendations score them all."""
    return catalogue.orderBy(F.desc_nulls_last("validado_em"), F.desc_nulls_last("criado_em"), "id").limit(n)


def classify(catalogue: DataFrame, as_of: date) -> DataFrame:
    """(id, hay, trait) of every notice: the text an area is looked for in, and all else a score depends on.

    A trait has at most 108 values, so whatever is scored, counted or ranked per trait is small.
    """
    closes = F.coalesce(loose_date("data_encerramento"), F.try_to_timestamp("data_encerramento").cast("date"))
    unread = F.col("data_encerramento").isNull() | closes.isNull()
    return catalogue.select(
        "id", F.lower(F.concat_ws(" ", *[blank(c) for c in ("area", "titulo", "descricao", "sobre_programa")])).alias("hay"),
        F.struct(
            "is_researcher", "is_company", F.when(unread, 0).when(closes >= F.lit(as_of), 1).otherwise(2).alias("deadline"),
            (F.col("valor_projeto").isNotNull() | F.col("valor").isNotNull()).alias("has_value"),
            (F.col("sobre_programa").isNotNull() | F.col("criterios_elegibilidade").isNotNull()).alias("has_text"),
        ).alias("trait"),
    )


def _pieces(area: Column) -> Column:
    """The plain parts of an area: % and _ are wildcards, a backslash takes the next character literally."""
    # a literal character is kept apart from wildcards while the area is split at those
    marked = F.regexp_replace(F.regexp_replace(area, r"\\(.)", "\u0001$1"), r"(?<!\u0001)[%_]+", "\u0002")
    return F.filter(F.split(F.regexp_replace(marked, "\u0001", ""), "\u0002"), lambda p: p != "")


def _grams(text: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1)), lambda i: F.substring(text, i, n)))


def area_hits(keys: DataFrame, notices: DataFrame) -> DataFrame:
    """(area, id, trait) of the notices that an area matches as a case-insensitive pattern without anchors.

    An inverted index of short substrings finds them: of an area's own grams the one that fewest notices hold names the candidates, which are
    verified on the text. Only areas without a plain character (all wildcards) are compared with every notice, which they match.
    """
    areas = keys.select("area").where("area <> ''").distinct()
    # before any other character the backslash is left out, as the pattern language knows no such pair
    pattern = F.regexp_replace(F.concat(F.lit("%"), F.lower("area"), F.lit("%")), r"(\\[%_\\])|\\", "$1")
    areas = materialize(areas.select("area", pattern.alias("pattern"), F.transform(_pieces(F.lower("area")), lambda p: p).alias("pieces")), "areas")
    own = F.flatten(F.transform("pieces", lambda p: _grams(p, F.least(F.length(p), F.lit(GRAM)))))
    grams = areas.select("area", "pattern", F.explode(F.array_distinct(own)).alias("gram"))
    lengths = [r[0] for r in grams.select(F.length("gram")).distinct().collect()]  # at most GRAM numbers
    listed = F.explode(F.flatten(F.array(*[_grams(F.col("hay"), n) for n in sorted(lengths)])) if lengths else F.array().cast("array<string>"))
    wanted = grams.select("gram").distinct()
    index = materialize(notices.select("id", listed.alias("gram")).join(wanted, "gram", "left_semi"), "index")
    holders = index.groupBy("gram").agg(F.count("*").alias("holders"))
    rarest = grams.join(holders, "gram", "left").groupBy("area", "pattern").agg(F.min(F.struct(F.coalesce("holders", F.lit(0)).alias("n"), "gram")).alias("g"))
    seeds = materialize(rarest.where("g.n > 0").select("area", "pattern", "g.gram"), "seeds")
    found = index.join(seeds, "gram").select("area", "pattern", "id").join(notices, "id").where(F.like("hay", F.col("pattern")))
    every = areas.where(F.size("pieces") == 0)
    any_ = notices.join(every, F.like("hay", F.col("pattern"))) if not every.isEmpty() else None
    found = found.select("area", "id", "trait")
    return materialize(found if any_ is None else found.unionByName(any_.select("area", "id", "trait")), "hits")


def _audience(n: Column, legacy: bool) -> tuple[Column, Column]:
    t = F.col("user_type")
    company = "pessoa-empresa" if legacy else "consultor"
    yes_r, yes_c = n["is_researcher"].eqNullSafe(True), n["is_company"].eqNullSafe(True)
    points = (
        F.when((t == "pesquisador") & yes_r, 45).when((t == "pesquisador") & n["is_researcher"].eqNullSafe(False), -50)
        .when((t == company) & yes_c, 45).when((t == company) & n["is_company"].eqNullSafe(False), -50)
    )
    reason = F.when((t == "pesquisador") & yes_r, REASON_RESEARCH).when((t == company) & yes_c, REASON_COMPANY)
    if legacy:
        both = (t == "ambos") & (yes_r | yes_c)
        points, reason = points.when(both, 35), reason.when(both, REASON_BOTH)
    return points.otherwise(0), reason


def _scored(groups: DataFrame, legacy: bool) -> DataFrame:
    """Add score and motivos to groups of equal notices (user_type, by_company, trait, hit)."""
    n, area = F.col("trait"), F.col("hit")
    points, who = _audience(n, legacy)
    total = (
        F.lit(10) + points + F.when(area, 25).otherwise(0) + F.when(n["deadline"] == 0, 5).when(n["deadline"] == 1, 15).otherwise(-35)
        + F.when(n["has_value"], 5).otherwise(0) + F.when(n["has_text"], 5).otherwise(0)
    )
    aligned = F.lit(REASON_AREA_PROFILE) if legacy else F.when(F.col("by_company"), REASON_AREA_COMPANY).otherwise(REASON_AREA_PROFILE)
    when = F.when(n["deadline"] == 0, REASON_NO_DEADLINE).when(n["deadline"] == 1, REASON_OPEN).otherwise(REASON_CLOSED)
    reasons = F.array_compact(F.array(who, F.when(area, aligned), when, F.when(n["has_value"], REASON_VALUE)))
    return groups.withColumns({"score": F.greatest(F.lit(0), F.least(F.lit(100), total)), "motivos": reasons})


class Scoring:
    """Scores of all notices for all scopes, by groups: a score depends on type, area and whether a company asks on one side, on the
    trait and on the area's hit on the other. ``groups`` holds (user_type, area, by_company, trait, hit, n, score, motivos)."""

    def __init__(self, scopes: DataFrame, catalogue: DataFrame, as_of: date, legacy: bool = False) -> None:
        self.scopes = scopes.withColumn("by_company", F.col("empresa_id").isNotNull())
        self.notices = materialize(classify(catalogue, as_of), "notices")
        keys = materialize(self.scopes.select("user_type", "area", "by_company").distinct(), "keys")
        self.hits = area_hits(keys, self.notices)
        self.traits = self.notices.groupBy("trait").agg(F.count("*").alias("all"))
        # at most 108 values, so every key meets them as an array
        every = self.traits.agg(F.collect_list(F.struct("trait", "all")).alias("x")).scalar()
        hit = materialize(self.hits.groupBy("area", "trait").agg(F.count("*").alias("hits")), "hits")
        met = keys.select("*", F.inline(every)).join(hit, ["area", "trait"], "left")
        parts = F.array(F.struct(F.lit(True).alias("hit"), F.coalesce("hits", F.lit(0)).alias("n")), F.struct(F.lit(False).alias("hit"), (F.col("all") - F.coalesce("hits", F.lit(0))).alias("n")))
        self.groups = materialize(_scored(met.select(*KEY, "trait", F.inline(parts)).where("n > 0"), legacy), "groups")


KEY = ("user_type", "area", "by_company")


def score_notices(scoring: Scoring, min_score: int = 25) -> DataFrame:
    """Per scope: notices scored, sum and maximum of the scores, notices of at least ``min_score``; no pair is ever a row."""
    sums = scoring.groups.groupBy(*KEY).agg(
        F.sum("n").alias("notices"), F.sum(F.col("n") * F.col("score")).alias("total"), F.max("score").cast("long").alias("best"),
        F.coalesce(F.sum(F.when(F.col("score") >= min_score, F.col("n"))), F.lit(0)).alias("eligible"),
    )
    return scoring.scopes.join(sums, list(KEY)).select("user_id", "empresa_id", "notices", "total", "best", "eligible")


def _ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """Add ``place`` (from 1) by id within the keys: ranges are ranked alone and shifted by the counts before them, so no task holds a key."""
    at = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*keys, "id").sortWithinPartitions(*keys, "id").withColumns({"part": F.spark_partition_id(), "line": at})
    ranged = materialize(ranged, "ranges")
    counts = ranged.groupBy("part", *keys).agg(F.count("*").alias("n"), F.min("line").alias("first"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    counts = materialize(counts.select("part", *keys, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "counts")
    return ranged.join(counts, ["part", *keys]).withColumn("place", F.col("before") + F.col("line") - F.col("first") + 1).drop("part", "line", "first", "before")


def _first_hits(hits: DataFrame, most: int | None) -> DataFrame:
    """The ``most`` hits with the least ids of each (area, trait): bounded heaps per salt, merged."""
    if most is None:
        return hits
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for keys in (("area", "trait", "salt"), ("area", "trait")):
        salted = salted.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).where(F.col("r") <= most).drop("r")
    return salted.drop("salt")


def _first_others(wanted: DataFrame, ranked: DataFrame, hits: DataFrame, most: int | None) -> DataFrame:
    """Of each wanted (area, trait, n): notices of the trait that the area does not hit, the ``most`` with the least ids among them.

    Ids are read as far as needed: a reach that hits use up is doubled, for the (area, trait) concerned alone.
    """
    if most is None:
        return wanted.select("area", "trait").join(ranked.select("trait", "id"), "trait").join(hits, ["area", "trait", "id"], "left_anti")
    placed = materialize(hits.join(wanted.select("area", "trait"), ["area", "trait"], "left_semi").join(ranked.select("id", "place"), "id").select("area", "trait", "place"), "placed")
    reach, done = materialize(wanted.select("area", "trait", "n", F.lit(most).cast("long").alias("reach")), "reach"), []
    while True:
        used = reach.join(placed, ["area", "trait"], "left").groupBy("area", "trait", "n", "reach").agg(F.count_if(F.col("place") <= F.col("reach")).alias("used"))
        used = materialize(used.withColumn("short", F.col("reach") - F.col("used") < F.least(F.lit(most), F.col("n"))), "used")
        done.append(used.where("NOT short").select("area", "trait", "reach"))
        reach = used.where("short").select("area", "trait", "n", (2 * F.col("reach")).alias("reach"))
        if reach.isEmpty():
            break
    found = reduce(DataFrame.unionByName, done).join(ranked.select("trait", "id", "place"), "trait").where("place <= reach")
    return found.select("area", "trait", "id").join(hits, ["area", "trait", "id"], "left_anti")


def top_recommendations(scoring: Scoring, min_score: int = 25) -> DataFrame:
    """Best notices of each scope within its limit, of all notices there are; ties by id. A scope without a limit gets all.

    Groups of equal score are taken from the best down until those before them fill the largest limit of their key; the others are never
    listed. Of a group only as many members are listed as the limit asks for.
    """
    limits = scoring.scopes.groupBy(*KEY).agg(F.when(F.count_if(F.col("v_limit").isNull()) == 0, F.max("v_limit")).alias("most"))
    bound = limits.agg(F.when(F.count_if(F.col("most").isNull()) == 0, F.max("most")).alias("m")).first()["m"]
    best_first = Window.partitionBy(*KEY).orderBy(F.desc("score"))
    sums = scoring.groups.where(F.col("score") >= min_score).groupBy(*KEY, "score").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most 101 scores
    reached = sums.withColumn("before", before).join(limits, list(KEY)).where("most IS NULL OR before < most").select(*KEY, "score")
    groups = materialize(scoring.groups.join(reached, [*KEY, "score"], "left_semi"), "reached")

    listed = groups.where("hit").select("area", "trait").distinct()
    hits = _first_hits(scoring.hits.join(listed, ["area", "trait"], "left_semi"), bound).withColumn("hit", F.lit(True))
    wanted = groups.where("NOT hit").groupBy("area", "trait").agg(F.max("n").alias("n"))
    others = _first_others(wanted, _ranked(scoring.notices.select("trait", "id"), "trait"), scoring.hits, bound).withColumn("hit", F.lit(False))
    members = materialize(hits.select("area", "trait", "hit", "id").unionByName(others.select("area", "trait", "hit", "id")), "members")

    rows = groups.select(*KEY, "trait", "hit", "score", "motivos").join(members, ["area", "trait", "hit"])
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("score"), "id")))
    rows = materialize(rows if bound is None else rows.where(F.col("rank") <= bound), "best")
    found = scoring.scopes.join(rows, list(KEY)).where(F.col("v_limit").isNull() | (F.col("rank") <= F.col("v_limit")))
    return found.select("user_id", "empresa_id", "rank", F.col("id").alias("edital_id"), "score", "motivos")


def replace_scope_rows(stored: DataFrame, new: DataFrame, scopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next snapshot with the scopes' rows replaced, and rows inserted per scope."""
    key = [stored["user_id"] == scopes["user_id"], stored["empresa_id"].eqNullSafe(scopes["empresa_id"])]
    kept = stored.join(scopes, key, "left_anti")
    counts = new.groupBy("user_id", "empresa_id").agg(F.count("*").alias("inserted"))
    return kept.unionByName(new, allowMissingColumns=True), counts


def upsert_scope_rows(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Older form: rows of the same (user, notice) updated, others kept."""
    kept = stored.join(new.select("user_id", "edital_id").distinct(), ["user_id", "edital_id"], "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def digits(c: str) -> Column:
    return none_if_blank(F.regexp_replace(blank(c), r"\D", ""))


def backfill_companies(profiles: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies of consultants with a tax id who do not have that company yet."""
    p = profiles.where("user_type = 'consultor' AND has_cnpj").withColumn("d", digits("cnpj")).where("d IS NOT NULL")
    have = companies.select(F.col("owner_user_id").alias("user_id"), F.col("cnpj").alias("d"))
    return p.join(have, ["user_id", "d"], "left_anti").select(
        F.col("user_id").alias("owner_user_id"), F.coalesce(none_if_blank(F.trim("cnpj")), F.lit("Empresa")).alias("razao_social"),
        F.col("d").alias("cnpj"), "area", F.lit('{"migrated_from_profile":true}').alias("dados"),
    )


def remap_user_types(profiles: DataFrame) -> DataFrame:
    out = profiles.withColumn("user_type", remapped_type("user_type"))
    return out.withColumn("valid", F.col("user_type").isNull() | F.col("user_type").isin(*USER_TYPES))


def propagate_company(proposals: DataFrame, projects: DataFrame) -> DataFrame:
    p = projects.where("empresa_id IS NOT NULL").select(F.col("id").alias("projeto_id"), F.col("empresa_id").alias("_e"))
    missing = proposals.where("empresa_id IS NULL").join(p, "projeto_id", "left").withColumn("empresa_id", F.col("_e")).drop("_e")
    # proposals that already have a company never enter the join
    return proposals.where("empresa_id IS NOT NULL").unionByName(missing)


def check_constraints(recommendations: DataFrame, companies: DataFrame, projects: DataFrame) -> DataFrame:
    """Violated rows per integrity rule (rule, key, n)."""

    def duplicates(df: DataFrame, rule: str, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(rule).alias("rule"), F.concat_ws("/", *keys).alias("key"), "n")

    def rows(df: DataFrame, rule: str, bad: Column) -> DataFrame:
        return df.where(bad).select(F.lit(rule).alias("rule"), F.col("id").cast("string").alias("key"), F.lit(1).cast("long").alias("n"))

    states = F.array(*[F.lit(s) for s in STATES])
    parts = [
        duplicates(recommendations.where("empresa_id IS NULL"), "recommendation_user", "user_id", "edital_id"),
        duplicates(recommendations.where("empresa_id IS NOT NULL"), "recommendation_company", "user_id", "empresa_id", "edital_id"),
        duplicates(companies.where(F.length(F.trim("cnpj")) > 0), "company_tax_id", "owner_user_id", "cnpj"),
        rows(projects, "project_audience", ~F.col("publico_alvo").isin(*AUDIENCES)),
        rows(projects, "project_state", ~F.col("status").isin(*PROJECT_STATES)),
        rows(projects, "project_states_of_country", F.size(F.array_except("abrangencia_ufs", states)) > 0),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
