"""Deadline expressions: date mentions, priorities, timelines and activity."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import month_date
from .text import WB_END, WB_START, blank, grab, grab_all, has, let, none_if_blank, says, squish, strip

# Month names and abbreviations without accents.
MONTHS = {
    "janeiro": 1, "jan": 1, "fevereiro": 2, "fev": 2, "marco": 3, "mar": 3, "abril": 4, "abr": 4, "maio": 5, "mai": 5,
    "junho": 6, "jun": 6, "julho": 7, "jul": 7, "agosto": 8, "ago": 8, "setembro": 9, "set": 9, "outubro": 10, "out": 10,
    "novembro": 11, "nov": 11, "dezembro": 12, "dez": 12,
}
# Texts that mean "nothing was found".
MISSING = ("", "null", "undefined", "não informado", "nao informado", "não informado pelo edital", "nao informado pelo edital")
# What names a submission or registration phase.
SUBMISSION_WORDS = r"submiss|envio|propost|cadastr"
REGISTRATION_WORDS = r"inscri|habilit|registr"
ACCENTED, PLAIN = "áàâãäåéèêëíìîïóòôõöúùûüçñ", "aaaaaaeeeeiiiiooooouuuucn"

# Date forms and the wording before a deadline.
ISO = r"\d{4}-\d{2}-\d{2}"
DMY4 = r"\d{1,2}[\/\-.]\d{1,2}[\/\-.]\d{4}"
DMY2 = r"\d{1,2}[\/\-.]\d{1,2}[\/\-.]\d{2}" + WB_END
LETTERS = r"[A-Za-zÀ-ÿçÇ]+"
LONG_DATE = WB_START + r"\d{1,2}\s+de\s+" + LETTERS + r"\s+de\s+\d{4}" + WB_END
SHORT_DATE = WB_START + r"\d{1,2}\s+" + LETTERS + r"\s+\d{4}" + WB_END
TOKEN = ISO + r"|\d{1,2}[\/\-.]\d{1,2}[\/\-.]\d{2,4}"
END_OF = WB_START + "fim" + WB_END + r"\s*:?\s*(" + ISO + "|" + DMY4 + r"|\d{1,2}\s+de\s+[a-z]+\s+de\s+\d{4}|\d{1,2}\s+[a-z]+\s+\d{4})"
UNTIL = (
    WB_START + "ate" + WB_END + r"(?:\s+o\s+dia)?\s*(" + ISO
    + r"|\d{1,2}[\/\-.]\d{1,2}[\/\-.]\d{2,4}|\d{1,2}\s+de\s+[a-z]+\s+de\s+\d{2,4}|\d{1,2}\s+[a-z]+\s+\d{2,4})"
)
RANGE = (
    "(" + ISO + "|" + DMY4 + r")\s*(?:-|–|—|" + WB_START + "a" + WB_END + "|" + WB_START + "ate" + WB_END + "|" + WB_START
    + "até(?=[0-9A-Za-z_])|" + WB_START + "to" + WB_END + r")\s*(" + ISO + "|" + DMY4 + ")"
)
UNTIL_DAY = WB_START + "ate" + WB_END + r"(?:\s+o\s+dia)?\s*(\d{1,2}[\/\-.]\d{1,2}[\/\-.]\d{2,4})"
END_DAY = WB_START + "fim" + WB_END + r"\s*:?\s*(\d{1,2}[\/\-.]\d{1,2}[\/\-.]\d{2,4})"
TIMELINE = "struct<fases: array<struct<nome: string, prazo: string, status: string, data_inicio: string, data_fim: string, fim: string>>, json: string>"


def plain(c: Column | str) -> Column:
    """Lower case without accents."""
    return F.trim(F.translate(F.lower(blank(c)), ACCENTED, PLAIN))


def is_missing(c: Column | str) -> Column:
    return says(squish(c), *MISSING)


def _numeric(s: Column, pattern: str, order: str) -> Column:
    parts = {k: grab(s, pattern, i + 1).cast("int") for i, k in enumerate(order)}
    year = parts["y"]
    year = F.when(F.length(grab(s, pattern, order.index("y") + 1)) > 2, year).otherwise(F.when(year <= 69, year + 2000).otherwise(year + 1900))
    return F.when(has(s, pattern), month_date(year, parts["m"], parts["d"]))


def _named(s: Column, pattern: str) -> Column:
    months = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])
    month = F.try_element_at(months, plain(grab(s, pattern, 2)))
    day, year = grab(s, pattern, 1).cast("int"), grab(s, pattern, 3).cast("int")
    return F.when(month.isNotNull() & (day > 0) & (year > 0), month_date(year, month, day))


def loose_date(raw: Column | str, names: bool = True) -> Column:
    """A text that is one date (ISO may be followed by anything); other forms are no date."""

    def read(s):
        forms = [
            _numeric(s, r"^(\d{4})-(\d{2})-(\d{2})", "ymd"),
            _numeric(s, r"^(\d{1,2})[\/\-.](\d{1,2})[\/\-.](\d{4})$", "dmy"),
            _numeric(s, r"^(\d{1,2})[\/\-.](\d{1,2})[\/\-.](\d{2})$", "dmy"),
        ]
        if names:
            forms += [_named(s, rf"^(\d{{1,2}})\s+de\s+({LETTERS})\s+de\s+(\d{{4}})$"), _named(s, rf"^(\d{{1,2}})\s+({LETTERS})\s+(\d{{4}})$")]
        return F.coalesce(*forms)

    return let(strip(raw), read)


def date_mentions(text: Column | str) -> Column:
    """Every date in a text, by form."""
    tokens = let(blank(text), lambda t: F.concat(*[grab_all(t, p) for p in (ISO, DMY4, DMY2, LONG_DATE, SHORT_DATE)]))
    return F.array_compact(F.transform(tokens, lambda t: loose_date(t)))


def latest_mention(text: Column | str) -> Column:
    return F.array_max(date_mentions(text))


def phase_deadline(text: Column | str) -> Column:
    """Date after 'fim', else after 'até', else the right side of a range, else the latest."""
    return let(
        F.struct(blank(text).alias("t"), plain(text).alias("p")),
        lambda x: F.coalesce(
            latest_mention(grab(x["p"], END_OF)), latest_mention(grab(x["p"], UNTIL)), latest_mention(grab(x["t"], RANGE, 2)), latest_mention(x["t"])
        ),
    )


def text_deadline(text: Column | str) -> Column:
    """Date after 'até', else after 'fim', else the latest."""
    return let(
        F.struct(strip(text).alias("t"), plain(text).alias("p")),
        lambda x: F.coalesce(
            loose_date(F.coalesce(grab(x["p"], UNTIL_DAY), grab(x["t"], UNTIL_DAY))),
            loose_date(F.coalesce(grab(x["p"], END_DAY), grab(x["t"], END_DAY))),
            latest_mention(x["t"]),
        ),
    )


def phases(timeline: Column | str) -> Column:
    """Phases of a timeline, which may be wrapped as text in another one, up to three times."""

    def read(text, deeper):
        # without a brace there is no object; each level is parsed once, the next one only where it is needed
        level = F.when(F.contains(text, F.lit("{")), F.from_json(text, TIMELINE))
        return let(level, lambda l: F.coalesce(l["fases"], read(l["json"], deeper - 1)) if deeper else l["fases"])

    return let(blank(timeline), lambda t: read(t, 3))


def timeline_deadline(timeline: Column | str) -> Column:
    """Latest deadline of the submission, else registration, else all phases, with that phase's text and name."""

    def one(f, i):
        end = F.coalesce(f["data_fim"], f["fim"])
        by_end = F.when(blank(end) != "", F.coalesce(loose_date(end), latest_mention(end)))
        text = F.array_join(F.filter(F.array(f["prazo"], f["fim"], f["data_fim"], f["data_inicio"], f["nome"]), lambda x: x != ""), " | ")
        label = F.when(by_end.isNotNull(), F.coalesce(none_if_blank(f["prazo"]), end)).otherwise(F.coalesce(none_if_blank(f["prazo"]), f["fim"]))
        return F.struct(
            F.coalesce(by_end, phase_deadline(text)).alias("date"), (-i).alias("order"), none_if_blank(strip(label)).alias("prazo"), none_if_blank(strip(f["nome"])).alias("nome")
        )

    def chosen(fs):
        sub = F.filter(fs, lambda f: has(plain(f["nome"]), SUBMISSION_WORDS))
        reg = F.filter(fs, lambda f: has(plain(f["nome"]), REGISTRATION_WORDS))
        return F.when(F.size(sub) > 0, sub).when(F.size(reg) > 0, reg).otherwise(fs)

    dated = F.filter(F.transform(let(phases(timeline), chosen), one), lambda x: x["date"].isNotNull())
    return F.array_max(dated)


def until(d: Column) -> Column:
    return F.concat(F.lit("Até "), F.date_format(d, "dd/MM/yyyy"))


def closing_date(text: Column | str) -> Column:
    return F.coalesce(loose_date(text), latest_mention(text))


def derived_deadline(best: Column, closes: Column | str) -> Column:
    """Deadline text from a timeline's best phase, else from the closing date."""
    label_date = latest_mention(best["prazo"])
    from_label = (
        F.when(has(best["prazo"], r"^at[eé]\s"), best["prazo"])
        .when(has(best["prazo"], DMY4 + "|" + ISO), until(label_date))
        .otherwise(best["prazo"])
    )
    from_phase = F.when(best["prazo"].isNotNull() & label_date.isNotNull(), from_label).otherwise(until(best["date"]))
    return F.when(best.isNotNull(), from_phase).otherwise(until(closing_date(closes)))


def normalized_deadline(text: Column | str, most_chars: int | None = None) -> Column:
    """'Até <date>' keeping a two-digit year style; undated text stays, or only if it is no longer than ``most_chars``."""

    def read(x):
        raw, d = x["raw"], x["d"]
        label = F.when(has(raw, DMY2), F.date_format(d, "dd/MM/yy")).otherwise(F.date_format(d, "dd/MM/yyyy"))
        return (
            F.when(F.lower(raw).isin(*MISSING), F.lit(None).cast("string"))
            .when(d.isNull(), raw if most_chars is None else F.when(F.length(raw) <= most_chars, raw))
            .otherwise(F.concat(F.lit("Até "), label))
        )

    return let(F.struct(squish(text).alias("raw"), text_deadline(squish(text)).alias("d")), read)


def active_patterns(as_of: date, years: int = 4) -> list[str]:
    """Month/year strings of the rest of the year, then the next years."""
    months = [p for m in range(as_of.month, 13) for p in dict.fromkeys((f"{m:02d}/{as_of.year}", f"{m}/{as_of.year}"))]
    return months + [str(y) for y in range(as_of.year + 1, as_of.year + years + 1)]


def has_active_pattern(text: Column | str, as_of: date) -> Column:
    """One alternation of all patterns, no digit on either side; tried only where a digit begins."""
    return blank(text).rlike(r"(?=\d)(?<!\d)(?:" + "|".join(active_patterns(as_of)) + r")(?!\d)")


def token_dates(text: Column | str) -> Column:
    return F.array_compact(F.transform(grab_all(text, TOKEN), lambda t: loose_date(t, names=False)))


def in_active_window(d: Column, as_of: date, years: int = 4) -> Column:
    return (d >= F.lit(as_of.replace(day=1))) & (F.year(d) <= as_of.year + years)
