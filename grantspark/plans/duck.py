"""Snippets of DuckDB SQL for the oracles; written apart from the Spark expressions."""

from __future__ import annotations

from ..functions import titles as T

WS = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x},''), '{WS}+', ' ', 'g'))"


def has(x: str, p: str) -> str:
    return f"regexp_matches(coalesce({x},''), {q(p)}, 'i')"


def grab(x: str, p: str, g: int = 1) -> str:
    return f"CASE WHEN {has(x, p)} THEN regexp_extract(coalesce({x},''), {q(p)}, {g}, 'i') END"


def sub(x: str, p: str, r: str = "", opts: str = "gi") -> str:
    return f"regexp_replace(coalesce({x},''), {q(p)}, {q(r)}, '{opts}')"


def link_text(x: str) -> str:
    return f"trim({sub(sub(norm(x), r'^link\s+'), r'^[-–—•]\s+')})"


def num(x: str, *patterns: str) -> str:
    arms = " ".join(
        f"WHEN {has(x, p)} THEN regexp_extract(coalesce({x},''), {q(p)}, 1, 'i')||'/'||regexp_extract(coalesce({x},''), {q(p)}, 2, 'i')" for p in patterns
    )
    return f"CASE {arms} END"


# macros, created inline as SQL text: each takes a column name, so that expressions stay readable
def supp(x: str) -> str:
    return has(link_text(x), T.SUPPLEMENT)


def weak(x: str) -> str:
    t = link_text(x)
    return (
        f"(length({t}) < 10 OR {has(t, T.WEAK_DATE)} OR {has(t, T.WEAK_LABEL)} OR ({has(t, T.WEAK_RESULT)} AND NOT {has(t, T.MENTIONS_CALL)})"
        f" OR {has(t, T.WEAK_EXTRACT)} OR {has(t, T.WEAK_INSTITUTIONAL)})"
    )


def title(x: str, n: str, f: str) -> str:
    return (
        f"CASE WHEN NOT {supp(x)} AND NOT {weak(x)} THEN substring({link_text(x)},1,400) WHEN trim(coalesce({n},'')) <> '' THEN 'Edital '||trim({n})"
        f" ELSE 'Edital '||coalesce(nullif({f},''),'origem') END"
    )


def score(x: str) -> str:
    return f"CASE WHEN {supp(x)} OR {weak(x)} THEN 0 WHEN {has(link_text(x), T.GOOD_TITLE)} THEN 2 ELSE 1 END"


def parent(x: str) -> str:
    return f"coalesce({num(norm(x), *T.PARENT_NUMBER)}, '')"


def text_num(x: str) -> str:
    return f"coalesce({num(x, *T.TEXT_NUMBER)}, '')"


def text_of(x: str) -> str:
    out = f"regexp_replace(coalesce({x},''), '<[^>]*>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = f"replace({out}, {q(a)}, {q(b)})"
    return norm(out)


def element(x: str, tag: str) -> str:
    p = rf"<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    return f"CASE WHEN regexp_matches({x}, {q(p)}, 'si') THEN regexp_extract({x}, {q(p)}, 1, 'si') END"


def without(x: str, *tags: str) -> str:
    for t in tags:
        x = f"regexp_replace({x}, {q(rf'<{t}[\s>].*?</{t}\s*>')}, '', 'gsi')"
    return x


ANCHOR = r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""


def absurl(h: str, base: str) -> str:
    """For the link forms the derived pages hold: absolute, rooted, fragment, script and relative."""
    origin = f"regexp_extract({base}, '^([a-z]+://[^/?#]*)', 1)"
    folder = f"({origin}||coalesce(nullif(regexp_replace(regexp_extract({base}, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', ''), ''), '/'))"
    return (
        f"CASE WHEN trim({h}) = '' OR {has(f'trim({h})', '^(file:|#|javascript:)')} THEN '' WHEN {has(f'trim({h})', '^[a-z][a-z0-9+.-]*:')} THEN trim({h})"
        f" WHEN left(trim({h}),1) = '/' THEN {origin}||trim({h}) ELSE {folder}||trim({h}) END"
    )


def anchors(src: str, *keep: str) -> str:
    """SELECT of every usable anchor of ``src`` (page_id, url, html)."""
    extra = "".join(f", {k}" for k in keep)
    a = q(ANCHOR)
    return (
        f"SELECT * FROM (SELECT page_id, url{extra}, pos, trim(regexp_extract(m, {a}, 1, 'si')) AS href, {text_of(f'regexp_extract(m, {a}, 2, {q('si')})')} AS text,"
        f" {absurl(f'regexp_extract(m, {a}, 1, {q('si')})', 'url')} AS abs FROM (SELECT page_id, url{extra}, unnest(l) AS m, generate_subscripts(l,1)-1 AS pos"
        f" FROM (SELECT page_id, url{extra}, regexp_extract_all(html, {a}, 0, 'si') AS l FROM {src}) q0) q1) q2 WHERE abs <> ''"
    )


JUNK = r"integridade|compliance|codigo[_-]?conduta|politica[_-]?de|manual-do-usuario|logo|organograma|marca-da-"


def resolved(u: str) -> str:
    """For the moved host the derived pages hold."""
    return f"regexp_replace({u}, '^https?://(?:www\\.)?(?:download\\.)?finep\\.gov\\.br(/.*images/|/images/)', 'https://legacy.finep.gov.br\\1', 'i')"
