"""URL expressions: pruning rules, domain and site keys, link resolution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Host of an absolute or scheme-relative url, without user info and port.
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)"
DOMAIN = r"^(?:[hH][tT][tT][pP][sS]?://(?:[wW]{3}\.)?)?([^/?#:]*)"


def starts_with_http(url: Column) -> Column:
    """True for ``http://...``; ``https`` and upper case are refused."""
    return url.startswith("http://")


def contains_http(url: Column) -> Column:
    """True when ``http://`` occurs anywhere."""
    return url.contains("http://")


def any_http(url: Column) -> Column:
    """True for anything that starts with ``http`` in any case, https included."""
    return F.lower(F.substring(url, 1, 4)) == "http"


PRUNE_RULES: dict[str, Callable[[Column], Column]] = {
    "http": starts_with_http,
    "contains_http": contains_http,
    "any_http": any_http,
}


def prune(links: Column, rule: str = "http") -> Column:
    """Keep the array elements that satisfy a pruning rule."""
    return F.filter(links, PRUNE_RULES[rule])


def domain(url: Column) -> Column:
    """Domain of a url: scheme and one ``www.`` removed, cut at ``/ ? # :``.

    Root-relative links and bare fragments give the empty string and
    ``mailto:x`` gives ``mailto``.
    """
    return F.regexp_extract(url, DOMAIN, 1)


def host(url: Column) -> Column:
    """Host of a url, NULL when there is none."""
    return F.nullif(F.regexp_extract(url, HOST, 1), F.lit(""))


def site_key(url: Column) -> Column:
    """Host; a host that contains ``www`` loses its last label."""
    h = host(url)
    return F.when(h.contains("www"), F.regexp_replace(h, r"\.?[^.]*$", "")).otherwise(h)


def site_table_name(site: Column) -> Column:
    """Site key as a table name: dots become underscores."""
    return F.replace(site, F.lit("."), F.lit("_"))


# Parts of a reference: scheme, authority with its slashes, path, query with its mark, fragment with its mark.
_PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT = range(5)
# Segments that stand for this folder and the one above, a dot possibly written as its code.
_HERE, _ABOVE = r"\A(?:\.|%2[eE])\z", r"\A(?:\.|%2[eE]){2}\z"
_DOTTED = r"(?:^|/)(?:\.|%2[eE]){1,2}(?:/|$)"


def parts(url: Column) -> Column:
    """Array of scheme, authority, path, query, fragment; an absent part is empty. Marks belong to their parts, so that
    an empty query differs from none; blanks around the url and line ends in it do not count."""
    bare = F.regexp_replace(url, r"\A[\x00-\x20]++|[\x00-\x20]++\z|[\t\n\r]++", "")
    return F.split(F.regexp_replace(bare, r"(?s)" + _PARTS, "$1\n$2\n$3\n$4\n$5"), "\n", -1)


def without_dots(path: Column) -> Column:
    """The path with its dot segments carried out, as a fold over the segments: one that stands for the folder above
    takes the last one kept with it. The path begins with a slash; the result does too."""
    segments = F.split(path, "/", -1)
    segments = F.slice(segments, 2, F.size(segments))
    last = F.element_at(segments, -1)
    none = F.array().cast("array<string>")

    def step(kept: Column, segment: Column) -> Column:
        fewer = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment.rlike(_ABOVE), fewer).when(segment.rlike(_HERE), kept).otherwise(F.concat(kept, F.array(segment)))

    folded = F.aggregate(segments, none, step)
    ended = F.when(last.rlike(_ABOVE) | last.rlike(_HERE), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.when(path.rlike(_DOTTED), F.concat(F.lit("/"), F.array_join(ended, "/"))).otherwise(path)


def _resolved(base: Column, ref: Column) -> Column:
    """A parsed reference made absolute with a parsed base that has scheme and authority."""
    scheme, authority, path, query, fragment = (F.get(ref, n) for n in range(5))
    of_base = [F.get(base, n) for n in range(5)]
    # A reference with the scheme of its base and nothing of a host counts as relative, as browsers have it.
    same = (F.lower(scheme) == F.lower(of_base[_SCHEME])) & (authority == "") & ~path.startswith("/")
    foreign = (scheme != "") & ~same
    rooted = F.when(path.startswith("/"), without_dots(path)).otherwise(path)
    folder = F.regexp_extract(of_base[_PATH], r"^(.*/)", 1)
    merged = without_dots(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    relative = (
        F.when(authority != "", F.concat(authority, rooted, query))
        .when(path.startswith("/"), F.concat(of_base[_AUTHORITY], rooted, query))
        .when(path != "", F.concat(of_base[_AUTHORITY], merged, query))
        .otherwise(F.concat(of_base[_AUTHORITY], of_base[_PATH], F.when(query != "", query).otherwise(of_base[_QUERY])))
    )
    absolute = F.when(foreign, F.concat(scheme, F.lit(":"), authority, rooted, query)).otherwise(F.concat(of_base[_SCHEME], F.lit(":"), relative))
    return F.concat(absolute, fragment)


def _stands_alone(url: Column) -> Column:
    """Whether a parsed url can be a base."""
    return (F.get(url, F.lit(_SCHEME)) != "") & (F.length(F.get(url, F.lit(_AUTHORITY))) > 2)


def resolve_all(links: Column, base: Column) -> Column:
    """Every element of an array of links made absolute with the url ``base``; without an absolute base they stay as
    they are. NULL links stay NULL."""
    bound = F.transform(F.array(parts(base)), lambda b: F.transform(F.transform(links, parts), lambda ref: _resolved(b, ref)))
    return F.when(F.coalesce(_stands_alone(parts(base)), F.lit(False)), F.element_at(bound, 1)).otherwise(links)


def resolve(link: Column, page_url: Column) -> Column:
    """A link made absolute with the url of its page, as browsers do."""
    return F.get(resolve_all(F.array(link), page_url), F.lit(0))


def base_of(page_url: Column, base_href: Column) -> Column:
    """What the links of a page are resolved against: its base tag, itself relative to the page, or else the page."""
    return F.when(base_href.isNull(), page_url).otherwise(resolve(base_href, page_url))
