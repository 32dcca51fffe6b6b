"""URL expressions: resolution, rewriting, routability, storage names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, grab, has, let, strip, sub

ORIGIN = r"^([a-z][a-z0-9+.-]*:\/\/[^\/?#]*)"
# File names that are institutional documents, not notices.
JUNK_PDF = r"integridade|compliance|codigo[_-]?conduta|politica[_-]?de|manual-do-usuario|logo|organograma|marca-da-"
# Viewer pages that wrap the real file, and hosts whose files moved.
VIEWER_PATH = r"viewer\.php$|\/pdfjs\/"
MOVED_HOSTS = (
    # host without www, path pattern, new origin
    (r"^(finep\.gov\.br|download\.finep\.gov\.br)$", r"\/images\/", "https://legacy.finep.gov.br"),
    (r"^(10\.10\.10\.206|fapepi\.pi\.gov\.br)$", r"\/wp-content\/uploads\/", "https://www.fapepi.pi.gov.br"),
)


def url_part(url: Column | str, part: str, key: str | None = None) -> Column:
    args = [blank(url), F.lit(part)] + ([F.lit(key)] if key else [])
    return F.try_parse_url(*args)


def host(url: Column | str) -> Column:
    return F.lower(grab(url, r"^[a-z][a-z0-9+.-]*:\/\/(?:[^\/?#@]*@)?([^\/?#:]*)"))


def bare_host(url: Column | str) -> Column:
    return sub(host(url), r"^www\.")


def path(url: Column | str) -> Column:
    return F.coalesce(F.nullif(grab(url, ORIGIN + r"([^?#]*)", 2), F.lit("")), F.lit("/"))


def query(url: Column | str) -> Column:
    return F.coalesce(grab(url, r"^[^?#]*(\?[^#]*)"), F.lit(""))


def _no_dots(p: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; paths without them skip the fold."""
    folded = F.aggregate(
        F.split(p, "/"),
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(seg == ".", acc)
        .otherwise(F.array_append(acc, seg)),
    )
    return F.when(p.rlike(r"(^|\/)\.\.?(\/|$)"), F.array_join(folded, "/")).otherwise(p)


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """Link resolved against its page; empty for file:, # and javascript: links."""

    def join(h):
        origin = grab(base, ORIGIN)
        folder = F.regexp_replace(path(base), r"[^\/]*$", "")
        tail = F.coalesce(grab(h, r"([?#].*)$"), F.lit(""))
        bare = F.regexp_replace(h, r"[?#].*$", "")
        return (
            F.when((h == "") | has(h, r"^(file:|#|javascript:)"), F.lit(""))
            .when(has(h, r"^[a-z][a-z0-9+.-]*:\/\/[^\/?#]+$"), F.concat(h, F.lit("/")))
            .when(has(h, r"^[a-z][a-z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(grab(base, r"^([a-z][a-z0-9+.-]*:)"), h))
            .when(origin.isNull(), h)
            .when(h.startswith("/"), F.concat(origin, let(bare, _no_dots), tail))
            .when(h.startswith("?"), F.concat(origin, path(base), h))
            .otherwise(F.concat(origin, let(F.concat(folder, bare), _no_dots), tail))
        )

    return let(strip(href), join)


def is_pdf_link(url: Column | str) -> Column:
    return F.instr(F.lower(blank(url)), ".pdf") > 0


def is_junk_pdf(url: Column | str) -> Column:
    return has(url, JUNK_PDF)


def decoded(url: Column | str) -> Column:
    """Percent-decoding that keeps ``+`` and leaves malformed text alone."""
    return let(blank(url), lambda u: F.when(F.instr(u, "%") > 0, F.coalesce(F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), u)).otherwise(u))


def clean_pdf_url(url: Column | str) -> Column:
    u = decoded(strip(url))
    return strip(sub(sub(u, r"%20+$"), r"(\.pdf)\/view(?:[?#].*)?$", "$1"))


def _moved(u: Column) -> Column:
    out = u
    h = bare_host(u)
    for host_pattern, path_pattern, origin in MOVED_HOSTS:
        out = F.when(has(h, host_pattern) & has(path(u), path_pattern), F.concat(F.lit(origin), path(u), query(u))).otherwise(out)
    return out


def _unwrapped(u: Column) -> Column:
    inner = F.coalesce(grab(query(u), r"[?&]file=([^&]+)"), grab(query(u), r"[?&]pdf=([^&]+)"))
    nested = absolute_url(decoded(inner), u)
    return F.when(
        has(path(u), VIEWER_PATH) & inner.isNotNull(), let(nested, lambda n: F.when(is_pdf_link(n), clean_pdf_url(n)).otherwise(u))
    ).otherwise(u)


def resolve_pdf_url(url: Column | str) -> Column:
    """Effective address of a file: viewer pages unwrapped, moved hosts rewritten."""
    return let(let(clean_pdf_url(url), _unwrapped), _moved)


def is_unroutable(host_name: Column | str) -> Column:
    """Private, loopback, link-local, .local or missing host."""
    return let(F.lower(strip(host_name)), _private)


def _private(h: Column) -> Column:
    octet = [grab(h, r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$", i).cast("int") for i in range(1, 5)]
    valid = octet[0].isNotNull()
    for o in octet:
        valid = valid & (o <= 255)
    a, b = octet[0], octet[1]
    private = (
        a.isin(10, 127)
        | ((a == 192) & (b == 168))
        | ((a == 172) & b.between(16, 31))
        | ((a == 169) & (b == 254))
    )
    return (h == "") | (h == "localhost") | h.endswith(".local") | F.coalesce(valid & private, F.lit(False))


def path_segment(text: Column | str, limit: int | None = 100) -> Column:
    """Text as one storage segment; null ``limit`` keeps it whole."""
    t = F.regexp_replace(blank(text), r"[^a-zA-Z0-9._-]", "_")
    t = F.regexp_replace(F.regexp_replace(t, r"_{2,}", "_"), r"^_+|_+$", "")
    return t if limit is None else F.substring(t, 1, limit)


def last_part(url: Column | str) -> Column:
    """Last part of an address's path, decoded: what a file name is made from."""
    return decoded(F.coalesce(F.nullif(grab(F.regexp_replace(path(url), r"\/+$", ""), r"([^\/]+)$"), F.lit("")), F.lit("edital.pdf")))


def file_name(url: Column | str, limit: int | None = 200) -> Column:
    name = path_segment(last_part(url), limit)
    return F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))


def path_parts(source: Column | str, number: Column | str, url: Column | str, limits: tuple[int | None, int | None] = (100, 200)) -> Column:
    """The three segments of a storage path."""

    def seg(c):
        return path_segment(F.coalesce(F.nullif(blank(c), F.lit("")), F.lit("unknown")), limits[0])

    return F.array(seg(source), seg(number), file_name(url, limits[1]))


def storage_path(source: Column | str, number: Column | str, url: Column | str) -> Column:
    return F.array_join(path_parts(source, number, url), "/")


def whole_path(source: Column | str, number: Column | str, url: Column | str) -> Column:
    """The storage path with nothing cut off: what tells files apart whose cut paths are equal."""
    return F.array_join(path_parts(source, number, url, (None, None)), "/")


def with_mark(name: Column, mark: Column) -> Column:
    """A file name or path with a mark before its ending."""
    return F.concat(F.regexp_replace(name, r"(?i)\.pdf$", ""), F.lit("-"), mark, F.coalesce(grab(name, r"(\.pdf)$"), F.lit(".pdf")))
