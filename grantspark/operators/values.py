"""Money extraction and the structured value of a project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions.frames import compute
from ..functions.text import blank, has, let, none_if_blank, squish
from ..session import materialize

# Wording of programme totals, of per-project values, foreign money, ranges and monthly pay.
TOTAL_WORDS = (
    r"(?<![0-9A-Za-z_])(global|total|totaliza\w*|dota[cç][aã]o|or[cç]amento|montante|capital comprometido|investimento"
    r"|recursos?\s+(?:financeiros?\s+)?(?:totais|dispon[ií]ve(?:l|is)|destinados?|previstos?|alocados?))(?![0-9A-Za-z_])"
)
PER_PROJECT_WORDS = (
    r"(?<![0-9A-Za-z_])(?:por|cada|para cada)\s+(?:projeto|proposta|empresa|startup|benefici[aá]ri\w*|pesquisador\w*|bolsista|plano"
    r"|iniciativa|institui[cç][aã]o|ict|grupo|evento|candidat\w*|subprojeto)|(?<![0-9A-Za-z_])cada(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])individua\w*"
)
FOREIGN = r"€|(?<![0-9A-Za-z_])euros?(?![0-9A-Za-z_])|us\$|(?<![0-9A-Za-z_])usd(?![0-9A-Za-z_])|d[oó]lar|£|(?<![0-9A-Za-z_])libras?(?![0-9A-Za-z_])"
RANGE_WORDS = r"m[ií]nimo|(?<![0-9A-Za-z_])entre(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])de\s+r\$[^;]*?(?<![0-9A-Za-z_])a\s+r\$"
MONTHLY = r"\/\s*m[eê]s(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])mensa(?:l|is)(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])ao\s+m[eê]s(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])por\s+m[eê]s(?![0-9A-Za-z_])"
TOTAL_HINT = r"total|global|dota[cç][aã]o|or[cç]amento|montante|milh[oõ]|recursos (financeiros )?(dispon|previst|destinad)"
STRUCTURED = (
    "struct<valor: array<string>, bolsas: array<string>, por_projeto_min: double, por_projeto_max: double, por_projeto_origem: string,"
    " total_programa: double, total_programa_texto: string, qtd_projetos: int>"
)
#: Serialized structured values keep their null members.
AS_JSON = {"ignoreNullFields": "false"}


def extract_amounts(texts: DataFrame, column: str, *keep: str) -> DataFrame:
    return texts.select(*keep, F.posexplode(M.amounts(column)).alias("n", "amount"))


def parse_written_numbers(texts: DataFrame, column: str) -> DataFrame:
    return compute(texts, amount=M.written_amount(column))


def value_lines(texts: DataFrame, column: str, max_lines: int | None = None, max_chars: int | None = None) -> DataFrame:
    return compute(texts, lines=M.value_lines(column, max_lines, max_chars))


def flatten_value(notices: DataFrame, column: str = "valor_projeto") -> DataFrame:
    return compute(notices, lines=M.flat_lines(column))


def value_quality(notices: DataFrame, column: str = "valor_projeto", number: str = "numero") -> DataFrame:
    """Flags per value: matches its notice's number, invalid or money lines, suspicious, plausible."""
    n = compute(notices, lines=M.flat_lines(column))
    # each line is judged once, all flags read the verdicts
    judged = F.transform("lines", lambda l: let(M.has_money_signal(l), lambda money: F.struct(money.alias("money"), M.is_invalid(l, money).alias("invalid"))))
    n = compute(n, _j=judged, matches_number=M.matches_number(F.col("lines"), number))
    n = compute(
        n,
        any_invalid=F.exists("_j", lambda x: x["invalid"]),
        all_invalid=F.forall("_j", lambda x: x["invalid"]),
        any_money=F.exists("_j", lambda x: x["money"]),
        all_money=F.forall("_j", lambda x: x["money"]),
    ).drop("_j")
    suspicious = F.expr("size(lines) = 0 OR matches_number OR any_invalid OR NOT any_money")
    n = n.withColumn("suspicious", suspicious)
    return n.withColumn("plausible", F.expr("size(lines) > 0 AND NOT suspicious"))


def line_amounts(line: Column) -> Column:
    """Amounts of at least 100 in local money."""
    return F.when(has(line, FOREIGN), F.array().cast("array<double>")).otherwise(F.filter(M.amounts(line), lambda n: n >= 100))


def _positive(raw: Column) -> Column:
    """Positive number of a raw JSON value: a number, or the largest amount of a text."""
    plain = F.when(raw.rlike(r"^\d+(\.\d+)?([eE]\d+)?$"), raw.cast("double"))
    text = F.coalesce(F.array_max(line_amounts(raw)), M.money_token(F.regexp_replace(raw, r"[^\d.,]", "")))
    n = F.coalesce(plain, F.when(~raw.rlike(r"^-"), text))
    return F.when(n > 0, n)


def _project_count(raw: Column) -> Column:
    n = F.when(raw.rlike(r"^\d+$"), raw).otherwise(none_if_blank(F.regexp_replace(raw, r"\D", ""))).try_cast("long")
    return F.when(~raw.rlike(r"^\d+\.\d+$") & n.between(1, 100_000), n.cast("int"))


def parse_structured(value: Column | str) -> Column:
    """Stored structured value, NULL for other forms."""

    def at(m, k):
        return F.try_element_at(m, F.lit(k))

    def num(m, k):
        return F.when(at(m, k).rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), at(m, k).cast("double"))

    def read(m):
        origin = F.when(at(m, "por_projeto_origem").isin("edital", "projeto_unico"), at(m, "por_projeto_origem"))
        return F.when(
            M.is_structured(m),
            F.struct(
                M.clean_lines(at(m, "valor")).alias("valor"), M.clean_lines(at(m, "bolsas")).alias("bolsas"),
                num(m, "por_projeto_min").alias("por_projeto_min"), num(m, "por_projeto_max").alias("por_projeto_max"),
                origin.alias("por_projeto_origem"), num(m, "total_programa").alias("total_programa"),
                M.clean_line(at(m, "total_programa_texto")).alias("total_programa_texto"), _project_count(at(m, "qtd_projetos")).alias("qtd_projetos"),
            ),
        )

    return let(M.json_fields(value), read)


def _described(lines: Column) -> Column:
    """Each line with its amounts and what its wording says, worked out once."""

    def one(l):
        return let(
            F.struct(M.amounts(l).alias("all"), has(l, FOREIGN).alias("foreign")),
            lambda x: F.struct(
                l.alias("t"),
                F.when(x["foreign"], F.array().cast("array<double>")).otherwise(F.filter(x["all"], lambda n: n >= 100)).alias("ns"),
                ((F.size(x["all"]) > 0) | (x["foreign"] & l.rlike(r"\d"))).alias("amount"),
                x["foreign"].alias("foreign"),
                has(l, MONTHLY).alias("monthly"),
                (has(l, TOTAL_WORDS) & ~has(l, PER_PROJECT_WORDS)).alias("total"),
                has(l, RANGE_WORDS).alias("range"),
            ),
        )

    return F.transform(lines, one)


def structure_value(rows: DataFrame, raw: str = "raw", context: str = "contexto", max_lines: int | None = None) -> DataFrame:
    """Per-project lines, stipends and programme total of a model answer, checked against its context.

    ``max_lines`` keeps only the first lines and stipends.
    """
    numbers = lambda c: F.flatten(F.transform(c, lambda l: l["ns"]))
    at = lambda k: F.try_element_at("m", F.lit(k))
    text = squish(raw)
    r = compute(rows, stored=parse_structured(raw), m=M.json_fields(raw), ctx=F.when(F.trim(blank(context)) != "", M.amounts(context)))
    plain = (text != "") & ~text.startswith("{")
    lines = F.when(plain & text.startswith("["), M.clean_lines(text)).when(plain, F.array_distinct(F.array_compact(F.transform(M.value_lines(raw), lambda x: M.clean_line(x)))))
    is_number = at("total_programa").rlike(r"^\d+(\.\d+)?([eE]\d+)?$")
    total_text = F.coalesce(M.clean_line(at("total_programa_texto")), F.when(~is_number, M.clean_line(at("total_programa"))))
    r = compute(
        r,
        linhas=F.coalesce(lines, M.clean_lines(F.coalesce(at("por_projeto"), at("valor")))),
        bolsas=M.clean_lines(at("bolsas")),
        total_text=F.array_compact(F.array(total_text)),
        total_num=F.when(is_number, at("total_programa").cast("double")),
        qtd=_project_count(at("qtd_projetos")),
        llm_min=_positive(at("por_projeto_min")),
        llm_max=_positive(at("por_projeto_max")),
        usable=F.col("m").isNotNull() | plain,
    )
    r = compute(r, linhas=_described(F.col("linhas")), bolsas=_described(F.col("bolsas")), total_text=_described(F.col("total_text")))
    in_context = lambda n: F.col("ctx").isNull() | F.exists("ctx", lambda c: M.near(c, n))
    supported = lambda l: (F.size(l["ns"]) == 0) | F.exists(l["ns"], in_context)
    r = compute(r, linhas=F.filter("linhas", supported), bolsas=F.filter("bolsas", supported), total_text=F.filter("total_text", supported))
    # monthly pay is a stipend; a stipend without an amount says nothing
    monthly = F.filter("linhas", lambda l: l["monthly"])
    r = compute(r, linhas=F.filter("linhas", lambda l: ~l["monthly"]), bolsas=F.filter(F.array_union("bolsas", monthly), lambda l: l["amount"]))

    def repeats(l, others):
        return (F.size(l["ns"]) > 0) & F.forall(l["ns"], lambda n: F.exists(others, lambda o: M.near(o, n)))

    r = compute(
        r,
        linhas=F.filter("linhas", lambda l: ~repeats(l, numbers(F.col("bolsas")))),
        bolsas=F.filter("bolsas", lambda l, i: ~repeats(l, numbers(F.slice("bolsas", 1, i)))),
    )
    # lines that describe the whole call move to its total
    total_line = F.coalesce(F.get("total_text", F.lit(0)), F.get(F.filter("linhas", lambda l: l["total"]), F.lit(0)))
    r = compute(r, linhas=F.filter("linhas", lambda l: ~l["total"]), total_line=total_line)
    by_number = F.col("total_line").isNull() & F.col("total_num").isNotNull() & in_context(F.col("total_num"))
    r = compute(
        r,
        total=F.when(F.col("total_line").isNotNull(), F.array_max("total_line.ns")).when(by_number, F.col("total_num")),
        total_text=F.coalesce(F.col("total_line.t"), F.when(by_number, M.format_brl(F.col("total_num")))),
        per=numbers(F.col("linhas")),
    )
    differs = F.coalesce(F.exists("per", lambda n: ~M.near(n, F.col("total"))), F.lit(False))
    only_total = F.col("total").isNotNull() & (F.size("per") > 0) & ~differs & ~F.col("qtd").eqNullSafe(F.lit(1))
    r = compute(
        r,
        linhas=F.when(only_total, F.filter("linhas", lambda l: F.lit(False))).otherwise(F.col("linhas")),
        per=F.when(only_total, F.array().cast("array<double>")).when(F.col("total").isNotNull() & differs, F.filter("per", lambda n: ~M.near(n, F.col("total")))).otherwise(F.col("per")),
    )
    top = F.array_max("per")
    low = F.when(F.coalesce((F.col("llm_min") < top) & in_context(F.col("llm_min")), F.lit(False)), F.col("llm_min")).when(
        (F.size("per") >= 2) & F.exists("linhas", lambda l: l["range"]), F.array_min("per")
    )
    guess = F.when((F.size("per") == 0) & F.exists("linhas", lambda l: ~l["foreign"]) & in_context(F.col("llm_max")), F.col("llm_max"))
    r = compute(r, low=low, high=F.coalesce(top, guess), linhas=F.transform("linhas", lambda l: l["t"]), bolsas=F.transform("bolsas", lambda l: l["t"]))
    odd = F.coalesce(F.col("total") < F.col("high"), F.lit(False))
    r = compute(r, total=F.when(~odd, F.col("total")), total_text=F.when(~odd, F.col("total_text")))
    single = (F.size("linhas") == 0) & F.col("total").isNotNull() & F.col("qtd").eqNullSafe(F.lit(1))
    line = F.concat(F.lit("até "), M.format_brl(F.col("total")), F.lit(" (projeto único apoiado pela chamada)"))
    built = F.struct(
        F.when(single, F.array(line)).otherwise(M.first_items("linhas", max_lines)).alias("valor"),
        M.first_items("bolsas", max_lines).alias("bolsas"),
        F.col("low").alias("por_projeto_min"),
        F.when(single, F.col("total")).otherwise(F.col("high")).alias("por_projeto_max"),
        F.when(single, "projeto_unico").when(F.size("linhas") > 0, "edital").alias("por_projeto_origem"),
        F.col("total").alias("total_programa"),
        F.col("total_text").alias("total_programa_texto"),
        F.col("qtd").alias("qtd_projetos"),
    )
    says_something = F.col("usable") & (single | (F.size("linhas") > 0) | (F.size("bolsas") > 0) | F.col("total_text").isNotNull())
    r = compute(r, estruturado=F.coalesce("stored", F.when(says_something, built)))
    return r.select(*rows.columns, "estruturado")


def merge_values(values: DataFrame, keys: list[str], order: str, column: str = "estruturado", max_lines: int | None = None) -> DataFrame:
    """One structured value per key: per-project part and total of the first that has them, union of stipends.

    Each part is an ordered minimum, so partial results combine before the shuffle. Stipends are made distinct as rows of
    (key, stipend) before a key's list is built, so a hot key is spread until only its result is left; ``max_lines``
    keeps the first ones.
    """
    # stored, as both parts below read it: working a value out costs far more than writing it
    v = materialize(values.where(F.col(column).isNotNull()).select(*dict.fromkeys([*keys, order, column])), "values")
    at = F.col(order)

    def first(expr, cond=None):
        return F.min_by(expr, at if cond is None else F.when(cond, at))

    has_lines = F.size(f"{column}.valor") > 0
    part = F.struct(*[F.col(f"{column}.{c}").alias(c) for c in ("valor", "por_projeto_min", "por_projeto_max", "por_projeto_origem")])
    total = F.struct(*[F.col(f"{column}.{c}").alias(c) for c in ("total_programa", "total_programa_texto")])
    count = F.col(f"{column}.qtd_projetos")
    base = v.groupBy(*keys).agg(
        F.coalesce(first(part, has_lines), first(part)).alias("p"),
        F.coalesce(first(total, F.col(f"{column}.total_programa_texto").isNotNull()), F.max_by(total, at)).alias("t"),
        first(count, count.isNotNull()).alias("q"),
    )
    lines = v.select(*keys, at.alias("_o"), F.posexplode(f"{column}.bolsas").alias("_i", "b"))
    unique = lines.groupBy(*keys, "b").agg(F.min(F.struct("_o", "_i")).alias("_at"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_at", "b"))), lambda x: x["b"])
    if max_lines is not None:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy("_at", "b"))
        unique = unique.withColumn("_rn", rank).where(F.col("_rn") <= max_lines)
    stipends = unique.groupBy(*keys).agg(ordered.alias("bolsas"))
    out = base.join(stipends, keys, "left")
    return out.select(
        *keys,
        F.struct(
            F.col("p.valor").alias("valor"), F.coalesce("bolsas", F.array().cast(M.STRINGS)).alias("bolsas"), "p.por_projeto_min", "p.por_projeto_max",
            "p.por_projeto_origem", "t.total_programa", "t.total_programa_texto", F.col("q").alias("qtd_projetos"),
        ).alias(column),
    )


def compact_value(
    rows: DataFrame, column: str = "valor_projeto", max_chars: int | None = None, line_chars: int | None = None, max_items: int | None = None
) -> DataFrame:
    """Storage form: structured JSON, a text of one line as is, else JSON of its lines.

    Nothing is cut unless a limit is given. Over ``max_chars`` lines are clipped at 120 characters and the last ones left
    out until the JSON fits, so that it always parses.
    """

    def listed(items):
        def json(xs):
            return F.to_json(F.struct(xs.alias("valor")))

        def fitting(xs):
            return F.aggregate(xs, F.array().cast(M.STRINGS), lambda kept, x: let(F.array_append(kept, x), lambda more: F.when(F.length(json(more)) <= max_chars, more).otherwise(kept)))

        whole = json(items)
        if max_chars is not None:
            whole = F.when(F.length(whole) <= max_chars, whole).otherwise(json(fitting(F.transform(items, lambda x: M.clip(x, 120)))))
        return F.when(F.size(items) > 0, whole)

    r = compute(rows, s=parse_structured(column), m=M.json_fields(column), t=squish(column), lines=M.value_lines(column, max_items, line_chars))
    items = F.filter(F.transform(M.raw_items(F.try_element_at("m", F.lit("valor"))), lambda v: M.clip(squish(v), line_chars)), lambda v: v != "")
    r = compute(r, items=M.first_items(items, max_items))
    one = F.col("t")
    if line_chars is not None:
        one = F.when(F.length("t") <= line_chars, F.col("t")).otherwise(F.coalesce(F.get("lines", F.lit(0)), M.clip(F.col("t"), line_chars)))
    text = F.when(F.size("lines") > 1, listed(F.col("lines"))).otherwise(one)
    stored = (
        F.when(F.col("s").isNotNull(), F.to_json("s", AS_JSON))
        .when(F.col("t") == "", F.lit(None).cast("string"))
        .when(F.col("m").isNotNull(), listed(F.col("items")))
        .otherwise(text)
    )
    return compute(r, compacted=stored).select(*rows.columns, "compacted")


def value_acceptance(notices: DataFrame, column: str = "valor_projeto", number: str = "numero") -> DataFrame:
    """accept, reject or model check before a value is stored."""
    q = value_quality(notices, column, number)
    verdict = (
        F.when(F.size("lines") == 0, "reject")
        .when(F.col("suspicious"), F.when(F.col("all_invalid"), "reject").otherwise("check"))
        .when(F.col("all_money"), "accept")
        .otherwise("check")
    )
    return q.withColumn("verdict", verdict).select(*notices.columns, "verdict")


def reextract_candidates(notices: DataFrame, attachments: DataFrame, catalogue: DataFrame | None = None, only_totals: bool = False) -> DataFrame:
    """Notices with a processed file whose value is still in an old form."""
    n = notices.where("valor_projeto IS NOT NULL").where(~M.is_structured(M.json_fields("valor_projeto")))
    if only_totals:
        n = n.where(has("valor_projeto", TOTAL_HINT))
    done = attachments.where("is_processed").select(F.col("edital_id").alias("id")).distinct()
    n = n.join(done, "id", "left_semi")
    return n.join(catalogue.select("id"), "id", "left_semi") if catalogue is not None else n
