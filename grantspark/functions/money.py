"""Brazilian money expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .deadlines import ACCENTED, PLAIN
from .text import WB_END, WB_START, blank, grab, grab_all, has, let, none_if_blank, squish

# Amount tokens; the alternatives are tried in this order.
BRL = r"r\s*\$\s*(\d{1,3}(?:\.\d{3})*(?:,\d{2})?|\d+(?:,\d{2})?)"
MILLIONS = r"(\d+(?:[.,]\d+)?)\s*(?:milhões|milhoes|milhão|milhao)" + WB_END
THOUSANDS = r"(\d+(?:[.,]\d+)?)\s*mil" + WB_END
# Number words.
NUMBER_WORDS = {
    "zero": 0, "um": 1, "uma": 1, "dois": 2, "duas": 2, "tres": 3, "quatro": 4, "cinco": 5, "seis": 6, "sete": 7,
    "oito": 8, "nove": 9, "dez": 10, "onze": 11, "doze": 12, "treze": 13, "catorze": 14, "quatorze": 14, "quinze": 15,
    "dezesseis": 16, "dezessete": 17, "dezoito": 18, "dezenove": 19, "vinte": 20, "trinta": 30, "quarenta": 40,
    "cinquenta": 50, "sessenta": 60, "setenta": 70, "oitenta": 80, "noventa": 90, "cem": 100, "cento": 100,
    "duzentos": 200, "trezentos": 300, "quatrocentos": 400, "quinhentos": 500, "seiscentos": 600, "setecentos": 700,
    "oitocentos": 800, "novecentos": 900,
}
# What a notice number, a bare date and a money wording look like.
NUMBER_LINE = r"^\d{1,10}\s*\/\s*\d{4}$"
DATE_LINE = r"^\d{1,2}\s*\/\s*\d{1,2}\s*\/\s*\d{2,4}$|^\d{4}-\d{2}-\d{2}$|^\d{1,2}\s+de\s+\w+\s+de\s+\d{4}$"
MONEY_WORDS = (
    WB_START + r"(milh[oõ]es?|mil|bolsa|teto|financiamento|contrapartida|recurso|dotacao|dotação|reais|real|us\$|€|orçamento|orcamento"
    r"|investimento|subvenção|subvencao|auxilio|auxílio|premio|prêmio|pagamento|mensal|anual|limite|maximo|máximo|minimo|mínimo)" + WB_END
)
STRINGS = "array<string>"
MARK = "\u0001"


def near(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(a, b, F.lit(1.0)) < 0.01


def money_token(raw: Column) -> Column:
    """Positive number of a token with Brazilian separators."""

    def read(s):
        t = F.when(s.rlike(r",\d{1,2}$"), F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(
            s.rlike(r"\.\d{3}"), F.replace(s, F.lit("."), F.lit(""))
        ).otherwise(s)
        n = grab(t, r"^(\d+(?:\.\d+)?)").cast("double")
        return F.when(n > 0, n)

    return let(F.regexp_replace(blank(raw), r"\s", ""), read)


def written_amount(text: Column | str) -> Column:
    """Number words with thousand and million steps; NULL unless one of those is named."""
    t = F.translate(F.lower(blank(text)), ACCENTED, PLAIN)
    t = squish(F.regexp_replace(squish(F.regexp_replace(t, r"[^\w\s]", " ")), WB_START + r"reais?" + WB_END, " "))
    words = F.create_map(*[x for k, v in NUMBER_WORDS.items() for x in (F.lit(k), F.lit(float(v)))])
    zero = F.struct(F.lit(0.0).alias("acc"), F.lit(0.0).alias("cur"))

    def step(s, tok):
        base = F.when(s["cur"] == 0, 1.0).otherwise(s["cur"])
        scale = F.when(tok.isin("milhoes", "milhao"), 1_000_000.0).when(tok == "mil", 1_000.0)
        return F.struct(
            F.when(scale.isNotNull(), s["acc"] + base * scale).otherwise(s["acc"]).alias("acc"),
            F.when(scale.isNotNull(), 0.0).otherwise(s["cur"] + F.coalesce(F.try_element_at(words, tok), F.lit(0.0))).alias("cur"),
        )

    def total(x):
        n = let(F.aggregate(F.split(x, " "), zero, step), lambda s: s["acc"] + s["cur"])
        return F.when(x.rlike(WB_START + r"(mil|milhao|milhoes)" + WB_END), F.when(n > 0, n))

    # folding case and accents costs far more than seeing that no step is named
    return F.when(has(text, r"m[iíìîï]l"), let(t, total))


def amounts(text: Column | str) -> Column:
    """Every amount of a text: tokens, millions, thousands, and written numbers in parentheses not already there."""

    def scaled(t, pattern, factor):
        found = F.transform(grab_all(t, pattern, 1), lambda m: money_token(F.replace(m, F.lit(","), F.lit("."))) * factor)
        return F.array_compact(found)

    none = F.array().cast("array<double>")

    def read(t):
        # each pattern is tried only where its fixed part is found
        in_brl = F.when(F.contains(t, F.lit("$")), F.array_compact(F.transform(grab_all(t, BRL, 1), lambda m: money_token(m)))).otherwise(none)
        steps = F.when(has(t, "mil"), F.concat(scaled(t, MILLIONS, 1_000_000.0), scaled(t, THOUSANDS, 1_000.0))).otherwise(none)

        def with_written(base):
            written = F.array_compact(F.transform(grab_all(t, r"\(([^)]+)\)", 1), lambda m: written_amount(m)))
            return F.aggregate(written, base, lambda acc, w: F.when(F.exists(acc, lambda a: near(a, w)), acc).otherwise(F.array_append(acc, w)))

        return let(F.concat(in_brl, steps), lambda base: F.when(F.contains(t, F.lit("(")), with_written(base)).otherwise(base))

    return let(blank(text), read)


def segments(text: Column | str) -> Column:
    """Text cut at each amount."""

    tidy = lambda p: F.trim(F.regexp_replace(F.trim(F.regexp_replace(p, r"(?iu)\s+e\s*$", "")), " e$", ""))

    def at_amounts(s):
        def led(marked):
            parts = F.filter(F.transform(F.slice(marked, 2, F.greatest(F.size(marked) - 1, F.lit(1))), tidy), lambda p: p != "")
            return F.when(F.size(marked) <= 2, F.array(s)).otherwise(let(parts, lambda ps: F.when(F.size(ps) == 0, F.array(s)).otherwise(ps)))

        return let(F.split(F.regexp_replace(s, "(?iu)(" + BRL + ")", MARK + "$1"), MARK), led)

    def cut(s):
        by_and = F.filter(F.transform(F.split(s, r"(?iu)\s+e\s+(?=r\s*\$)"), lambda p: F.trim(p)), lambda p: p != "")
        several = let(by_and, lambda ps: F.when(F.size(ps) > 1, ps).otherwise(at_amounts(s)))
        # both ways of cutting look for the sign; a mark already in the text is a cut, too
        return F.when(s == "", F.array().cast(STRINGS)).when(F.contains(s, F.lit("$")) | F.contains(s, F.lit(MARK)), several).otherwise(F.array(s))

    return let(squish(text), cut)


def clip(t: Column, limit: int | None) -> Column:
    if limit is None:
        return t
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit - 1), F.lit("…"))).otherwise(t)


def first_items(items: Column | str, limit: int | None) -> Column:
    return F.slice(items, 1, limit) if limit is not None else F.col(items) if isinstance(items, str) else items


def value_lines(text: Column | str, max_lines: int | None = None, max_chars: int | None = None) -> Column:
    """Distinct lines, one per amount, first parenthesis dropped; all of them, whole, unless limited."""

    def line(seg):
        bare = squish(F.regexp_replace(seg, r"^([^(]*)\([^)]+\)", "$1"))
        return clip(F.when(seg.rlike(r"\([^)]+\)") & (bare != ""), bare).otherwise(seg), max_chars)

    return first_items(F.array_distinct(F.transform(segments(text), line)), max_lines)


def json_fields(value: Column | str) -> Column:
    """Top-level keys of a JSON object as raw text, NULL for anything else."""
    return let(squish(value), lambda t: F.when(t.startswith("{"), F.from_json(t, "map<string,string>")))


def clean_line(raw: Column, limit: int | None = None) -> Column:
    def read(t):
        return F.when((t != "") & ~has(t, r"^(null|n[aã]o informado)$"), clip(t, limit))

    return let(squish(raw), read)


def raw_items(raw: Column) -> Column:
    """Items of a raw JSON value: array of texts or {valor}, or one text."""
    items = F.when(raw.isNull(), F.array().cast(STRINGS)).when(F.trim(raw).startswith("["), F.from_json(raw, STRINGS)).otherwise(F.array(raw))
    return F.transform(items, lambda x: F.when(F.trim(x).startswith("{"), F.get_json_object(x, "$.valor")).otherwise(x))


def clean_lines(raw: Column) -> Column:
    return F.array_distinct(F.array_compact(F.transform(raw_items(raw), lambda x: clean_line(x))))


def is_structured(fields: Column) -> Column:
    return F.coalesce(F.map_contains_key(fields, "por_projeto_origem"), F.lit(False))


def flat_lines(value: Column | str) -> Column:
    """Readable lines of a value column in any of its storage forms."""

    def at(m, k):
        return F.try_element_at(m, F.lit(k))

    def read(x):
        m, t = x["m"], x["t"]
        total = clean_line(at(m, "total_programa_texto"))
        structured = F.concat(clean_lines(at(m, "valor")), clean_lines(at(m, "bolsas")), F.array_compact(F.array(total)))
        legacy = F.filter(F.transform(raw_items(at(m, "valor")), lambda v: squish(v)), lambda v: v != "")
        return (
            F.when(m.isNotNull() & is_structured(m), structured)
            .when(m.isNotNull(), legacy)
            .when(t == "", F.array().cast(STRINGS))
            .otherwise(F.array(t))
        )

    return let(F.struct(json_fields(value).alias("m"), squish(value).alias("t")), read)


def number_reference(text: Column | str) -> Column:
    """``n/yyyy`` without leading zeros, NULL unless the text is just that."""

    def read(t):
        n = F.coalesce(none_if_blank(grab(t, r"^0*([1-9]\d*)\/\d{4}$")), F.lit("0"))
        return F.when(t.rlike(r"^\d{1,10}\/\d{4}$"), F.concat(n, F.lit("/"), grab(t, r"\/(\d{4})$")))

    return let(F.regexp_replace(blank(text), r"\s", ""), read)


def looks_like_number(line: Column) -> Column:
    return ~has(line, r"r\s*\$") & has(squish(line), NUMBER_LINE)


def has_money_signal(line: Column) -> Column:
    return let(
        F.trim(blank(line)), lambda t: (t != "") & ((F.size(amounts(t)) > 0) | written_amount(t).isNotNull() | has(t, MONEY_WORDS))
    )


def is_invalid(line: Column, money: Column | None = None) -> Column:
    """Clearly no value; ``money`` is the line's money signal where already known."""
    signal = money if money is not None else has_money_signal(line)
    return let(squish(line), lambda t: (t == "") | looks_like_number(t) | has(t, DATE_LINE) | (t.rlike(r"^\d[\d.\/\s-]*$") & ~signal))


def matches_number(lines: Column, number: Column | str) -> Column:
    compact = lambda c: F.lower(F.regexp_replace(blank(c), r"\s", ""))

    def found(x):
        return x["ref"].isNotNull() & F.exists(lines, lambda l: F.coalesce(number_reference(l) == x["ref"], F.lit(False)) | (compact(l) == x["own"]))

    return let(F.struct(number_reference(number).alias("ref"), compact(number).alias("own")), found)


def format_brl(n: Column) -> Column:
    return F.concat(F.lit("R$ "), F.translate(F.format_number(n, 2), ",.", ".,"))
