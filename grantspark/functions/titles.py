"""Title quality and notice-number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, grab, has, let, squish, sub

# What marks a link text as a supplement of another notice.
SUPPLEMENT = (
    r"^(ADENDO|RETIFICA[ÇC][ÃA]O|ERRATA|REPUBLICA[ÇC][ÃA]O|EXTRATO|ANEXO|NOTA\s+EXPLICATIVA|AVISO"
    r"|ESCLARECIMENTO|RESULTADO|HOMOLOGA[ÇC][ÃA]O|ATA\s+DE)"
)
# Link texts that never make a title.
WEAK_DATE = r"^[\d]{1,2}\/[\d]{4}\s*[-–—]?\s*$"
WEAK_LABEL = r"^(download|saiba mais|ver mais|clique aqui|leia mais)$"
WEAK_RESULT = r"^resultado\s+(preliminar|final|complementar)"
WEAK_EXTRACT = r"^(extrato|homologa[çc][ãa]o)\s+(do|de)\s+resultado"
WEAK_INSTITUTIONAL = r"^(organograma|plano de dados|c[óo]digo de conduta)"
MENTIONS_CALL = r"edital|chamada"
GOOD_TITLE = r"edital|chamada|sele[cç][ãa]o|programa|fomento|bolsa"
# Where a parent number may stand, most specific first.
PARENT_NUMBER = (
    r"edital\s*(?:de\s+chamada\s+p[uú]blica\s*)?n[º°.]?\s*(\d+)\s*\/\s*(\d{4})",
    r"chamada\s+p[uú]blica\s*n[º°.]?\s*(\d+)\s*\/\s*(\d{4})",
    r"(?:referente|referente\s+ao|relativo\s+ao|ao|do|da)\s+edital\s*n[º°.]?\s*(\d+)\s*\/\s*(\d{4})",
    r"(?:do|da|ao|no|na)\s+edital\s+(\d+)\s*\/\s*(\d{4})",
    r"edital\s*n[º°.]?\s*(\d+)\s*\/\s*(\d{4})",
)
OWN_NUMBER = (
    r"N[º°]?\s*(\d+)\s*\/\s*(\d{4})",
    r"Edital\s*(\d+)\s*\/\s*(\d{4})",
    r"(\d{1,4})\/(\d{4})",
)
TEXT_NUMBER = (r"n[º°]?\s*(\d+)\s*\/\s*(\d{4})", r"(\d{1,4})\s*\/\s*(\d{4})")
TITLE_NUMBER = (
    r"N[º°]?\s*(\d+)\s*\/\s*(\d{4})",
    r"Chamada[^\d]*(\d+)\s*\/\s*(\d{4})",
    r"(\d{1,3})\s*\/\s*(20\d{2})",
)
SLUG_NUMBER = (r"chamada-fapemig-(\d+)-(\d+)", r"(\d{2,3})-(\d{4})")


def link_text(text: Column | str) -> Column:
    """Link text without list markers."""
    return F.trim(sub(sub(squish(text), r"^link\s+"), r"^[-–—•]\s+"))


def number_by(text: Column | str, patterns: tuple[str, ...]) -> Column:
    """``n/yyyy`` by the first pattern found, NULL when none is."""

    def read(t):
        return F.coalesce(*[F.when(has(t, p), F.concat_ws("/", grab(t, p, 1), grab(t, p, 2))) for p in patterns])

    return let(blank(text), read)


def _supplement(t: Column) -> Column:
    return has(t, SUPPLEMENT)


def _weak(t: Column) -> Column:
    return (
        (F.length(t) < 10)
        | has(t, WEAK_DATE)
        | has(t, WEAK_LABEL)
        | (has(t, WEAK_RESULT) & ~has(t, MENTIONS_CALL))
        | has(t, WEAK_EXTRACT)
        | has(t, WEAK_INSTITUTIONAL)
    )


def is_supplement(text: Column | str) -> Column:
    return _supplement(link_text(text))


def is_weak(text: Column | str) -> Column:
    return let(link_text(text), _weak)


def parent_number(text: Column | str) -> Column:
    return F.coalesce(number_by(squish(text), PARENT_NUMBER), F.lit(""))


def text_number(text: Column | str) -> Column:
    return F.coalesce(number_by(text, TEXT_NUMBER), F.lit(""))


def title_number(text: Column | str) -> Column:
    return F.coalesce(number_by(text, TITLE_NUMBER), text_number(text))


def link_number(text: Column | str, block: Column | str | None = None) -> Column:
    """Grouping number: the parent's if one is named, else the text's own; orphan supplements have none."""

    def read(t):
        parent = F.nullif(parent_number(t), F.lit(""))
        if block is not None:
            parent = F.coalesce(parent, F.nullif(parent_number(block), F.lit("")))
        return F.coalesce(parent, F.when(~_supplement(t), number_by(t, OWN_NUMBER)), F.lit(""))

    return let(link_text(text), read)


def slug_number(href: Column | str) -> Column:
    """Number from a detail path such as ``/chamada-…-012-2026``, else from the path's ``n/yyyy``."""
    tail = F.when(F.instr(blank(href), "/chamada-") > 0, F.element_at(F.split(blank(href), "/chamada-"), 2))
    slug = F.coalesce(F.nullif(F.split(tail, "/")[0], F.lit("")), blank(href))
    return F.coalesce(number_by(slug, SLUG_NUMBER), number_by(href, (r"(\d+)\/(\d{4})",)), F.lit(""))


def build_title(text: Column | str, number: Column | str, source: Column | str, limit: int | None = None) -> Column:
    num = F.trim(blank(number))

    def title(t):
        return (
            F.when(~_supplement(t) & ~_weak(t), t)
            .when(num != "", F.concat(F.lit("Edital "), num))
            .otherwise(F.concat(F.lit("Edital "), F.coalesce(F.nullif(blank(source), F.lit("")), F.lit("origem"))))
        )

    built = let(link_text(text), title)
    return built if limit is None else F.substring(built, 1, limit)


def _score(t: Column) -> Column:
    return F.when(_supplement(t) | _weak(t), 0).when(has(t, GOOD_TITLE), 2).otherwise(1)


def title_score(text: Column | str) -> Column:
    return let(link_text(text), _score)


def preferred_title(current: Column, candidate: Column) -> Column:
    """The better of two titles; on a tie the current one stays."""

    def pick(pair):
        cur, cand, sc, sn = pair["cur"], pair["cand"], pair["sc"], pair["sn"]
        better = (sn > sc) | ((sn == sc) & (F.length(cand) > F.length(cur)))
        return F.when(cur == "", cand).when(cand == "", cur).when(better, cand).otherwise(cur)

    return let(
        F.struct(
            link_text(current).alias("cur"), link_text(candidate).alias("cand"),
            title_score(current).alias("sc"), title_score(candidate).alias("sn"),
        ),
        pick,
    )
