"""Per-source link rules (L03): which links of a listing are notices, which are files."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import blank, has
from ..functions.urls import host, is_pdf_link, path

# Every collected source.
SOURCES = (
    "finep", "rotadofomento", "plataforma-inovacao-industria", "fapern", "capta", "fapac", "secti", "funcap",
    "facepe", "fapdf", "fapeal", "fapema", "fapepi", "fapergs", "faperj", "fapesc", "fapespa", "fapesq",
    "fapitec", "fapt", "cnpq", "fapemig", "fapemat", "fapes", "prosas", "sigfapes", "bndes",
)


@dataclass(frozen=True)
class LinkRule:
    """A link is a notice if the host and path fit and the path, or the text, carries a hint."""

    source: str
    host: str
    path_hint: str
    require_path: str = ""
    exclude_path: str = ""
    exclude_url: str = ""
    text_hint: str = ""
    text_hint_path_chars: int = 0
    min_text: int = 0

    def matches(self, url: Column, text: Column) -> Column:
        p = path(url)
        hint = has(p, self.path_hint)
        if self.text_hint:
            hint = hint | (has(text, self.text_hint) & (F.length(p) > self.text_hint_path_chars))
        ok = has(host(url), self.host) & hint
        if self.require_path:
            ok = ok & has(p, self.require_path)
        if self.exclude_path:
            ok = ok & ~has(p, self.exclude_path)
        if self.exclude_url:
            ok = ok & ~has(url, self.exclude_url)
        if self.min_text:
            ok = ok & (F.length(blank(text)) >= self.min_text)
        return ok


_DATED = r"\/20\d{2}\/\d{2}\/\d{2}\/"
_CALL_WORDS = r"edital|chamada|chamamento|programa"
_BOARD_WORDS = r"edital|chamada|programa|bolsista|amplia|rede-de-pesquisa"
_NOT_A_POST = r"\/category\/|\/author\/|\/\d{4}\/\d{2}\/?$"

# The rule of each listing source (a source may have two).
RULES = (
    LinkRule("fapeal", r"fapeal\.br", r"\/edital", exclude_path=r"\/category\/"),
    LinkRule("fapema", r"fapema\.br", r"\/edital-fapema"),
    LinkRule("fapepi", r"fapepi", r"\/edital", exclude_path=r"^\/editais-fapepi\/?$", min_text=9),
    LinkRule("fapergs", r"fapergs", r"\/edital|\/chamada", exclude_path=r"^\/$|^\/abertos$|\/chamadas-e-editais",
             text_hint=r"edital|chamada", text_hint_path_chars=8),
    LinkRule("fapesc", r"fapesc\.sc\.gov\.br", r"\/edital-de-chamada"),
    LinkRule("fapespa", r"fapespa", _CALL_WORDS, require_path=_DATED, exclude_path=_NOT_A_POST, text_hint=_CALL_WORDS),
    LinkRule("fapespa", r"fapespa", r"\/edital|\/chamada", exclude_path=_NOT_A_POST + "|" + _DATED,
             text_hint=r"edital|chamada pública|chamada n"),
    LinkRule("fapesq", r"fapesq\.rpp\.br", r"\/editais\/\d{4}\/edital-no-"),
    LinkRule("fapitec", r"fapitec", r"\/editais-abertos\/edital"),
    LinkRule("fapt", r"to\.gov\.br", _BOARD_WORDS, require_path=r"\/fapt\/", text_hint=_BOARD_WORDS,
             exclude_path=r"01-editais-abertos|\/editais\/\w+$|\/institucional|\/manual|\/carta-de-servicos"),
    LinkRule("cnpq", r"gov\.br|cnpq\.br", r"chamada-no-|chamada-publica|chamadas-20\d{2}", require_path=r"\/chamadas\/",
             exclude_path=r"\.pdf$|abertas-para-submissao|analise-em-andamento|todas-as-chamadas\/?$",
             exclude_url=r"busca_|compartilh|facebook|twitter|linkedin|whatsapp|resultado",
             text_hint=r"chamada|edital", min_text=12),
    LinkRule("fapemat", r"fapemat\.mt\.gov\.br", r"\/w\/", min_text=8),
)

# Sources whose files are not simply "anything with .pdf".
FILE_ALSO = {"fapdf": "/documents/", "faperj": "rp/downloads"}
FILE_HOST = {"facepe": "facepe.br"}


def is_notice_link(source: Column, url: Column, text: Column) -> Column:
    return reduce(lambda a, b: a | b, [(source == r.source) & r.matches(url, text) for r in RULES])


def is_file_link(source: Column, url: Column) -> Column:
    out = is_pdf_link(url)
    for name, fragment in FILE_ALSO.items():
        out = out | ((source == name) & (F.instr(F.lower(url), fragment) > 0))
    for name, fragment in FILE_HOST.items():
        out = out & ((source != name) | (F.instr(url, fragment) > 0))
    return out
