"""HTML expressions: one walk over the lower-cased page yields the pieces that are asked
for, in order; everything else works on those pieces.

The walk takes comments, raw-text elements, tags and text one after the other, so what stands inside a
quoted value, a comment, a script, a title or a text area is never taken for a tag. One match skips any number
of pieces that nobody asked for. Repeated groups are possessive. Java runs those in a loop, where
greedy ones recurse and overflow the stack, and a tag without an end takes the rest
of the document once, so the time is linear in the page, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What follows a tag's name, up to its end; quotes count after an equals sign only.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""

_TAG = rf"/?[a-z!?]{_INSIDE}>?+"
_COMMENT = r"<!--(?:[^-]++|-(?!->))*+(?:-->)?+"
_TEXT = r"(?:[^<]++|<(?!/?[a-z!?]))++"

# Elements whose content is no markup: not shown on the page, and shown as it is written.
HIDDEN, SHOWN = ("script", "style", "title", "iframe"), ("textarea", "xmp")
# White space that is not a single blank already.
WIDE_SPACE = r"\s\s++|[\t\n\x0B\f\r]"


def _raw_text(tag: str) -> str:
    """An element whose content is no markup; unclosed, it reaches to the end."""
    return rf"<{tag}(?=[\s/>]){_INSIDE}>(?:[^<]++|<(?!/{tag}\s*+>))*+(?:</{tag}\s*+>)?+"


def _walk(tags: tuple[str, ...], text: bool) -> str:
    """Pattern of any pieces that are not wanted and the wanted one behind them, in group 1: a
    tag named in ``tags``, and with ``text`` the body's tags, text and shown raw text."""
    names = "|".join(tags)
    wanted = [rf"<(?:{names})(?=[\s/>]){_INSIDE}>"] if tags else []
    spared = [rf"(?:{names})[\s/>]"] if tags else []
    raw = [_raw_text(t) for t in HIDDEN]
    if text:
        wanted = [*map(_raw_text, SHOWN), *wanted, rf"<body(?=[\s/>]){_INSIDE}>?+", r"</body\s*+>", _TEXT]
        spared += [r"body[\s/>]", r"/body\s*+>", rf"(?:{'|'.join(SHOWN)})[\s/>]"]
        blank = r"\s++"
    else:
        raw += [_raw_text(t) for t in SHOWN]
        blank = _TEXT
    skipped = [blank, _COMMENT, *raw, rf"<(?!{'|'.join(spared)}){_TAG}"]
    return rf"(?:{'|'.join(skipped)})*+(?:({'|'.join(wanted)})|<{_TAG}|\z)"


def _attribute(tag: str, name: str) -> str:
    """Pattern of a tag, from its name on; group 1 is the raw value of the first
    ``name`` attribute."""
    other = rf"\s*+(?!{name}[\s=])[^\s>=]++(?:\s*+=\s*+{_VALUE})?+"
    return rf"\A<{tag}(?=[\s/])(?:{other})*+\s*+{name}\s*+=\s*+({_VALUE})"


# Named entities decoded in attribute values (fixed values); pages are in lower case.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "copy": "©", "reg": "®", "trade": "™", "hellip": "…", "ndash": "–", "mdash": "—", "bull": "•", "middot": "·",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»",
    "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "sect": "§", "deg": "°", "plusmn": "±", "times": "×",
    "agrave": "à", "aacute": "á", "acirc": "â", "atilde": "ã", "auml": "ä", "aring": "å", "aelig": "æ", "ccedil": "ç",
    "egrave": "è", "eacute": "é", "ecirc": "ê", "euml": "ë", "igrave": "ì", "iacute": "í", "icirc": "î", "iuml": "ï",
    "ntilde": "ñ", "ograve": "ò", "oacute": "ó", "ocirc": "ô", "otilde": "õ", "ouml": "ö", "oslash": "ø",
    "ugrave": "ù", "uacute": "ú", "ucirc": "û", "uuml": "ü", "yacute": "ý", "yuml": "ÿ", "szlig": "ß",
}
# An entity, the text up to the next one, or a bare ampersand.
ENTITY_OR_TEXT = r"&#x[0-9a-f]{1,6};|&#[0-9]{1,7};|&[a-z]{2,8};|[^&]++|&"


def pieces(html: Column, *tags: str, text: bool = False) -> Column:
    """The tags of these names in document order, lower-cased; with ``text`` also the body's own tags and all text.

    A NULL page has no pieces.
    """
    found = F.regexp_extract_all(F.lower(html), F.lit(_walk(tags, text)), 1)
    return F.coalesce(F.filter(found, lambda p: p != ""), F.array().cast("array<string>"))


def _character(code: Column) -> Column:
    """The character of a code point, NULL if there is none; a hard blank is a blank."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code == 160, F.lit(" ")).when(valid, character)


def _decoded(piece: Column) -> Column:
    named = F.create_map(*[F.lit(x) for name, char in ENTITIES.items() for x in (f"&{name};", char)])
    digits = F.regexp_extract(piece, r"\A&#x?([0-9a-f]+);", 1)
    code = F.when(piece.startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    return F.coalesce(F.when(piece.startswith("&#"), _character(code)).otherwise(named[piece]), piece)


def decode(value: Column) -> Column:
    """Every entity once, from left to right; what is none stays as written."""
    pieces = F.regexp_extract_all(value, F.lit(ENTITY_OR_TEXT), 0)
    decoded = F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("&"), _decoded(p)).otherwise(p)), "")
    return F.when(value.contains("&"), decoded).otherwise(value)


def _unquoted(raw: Column) -> Column:
    """Attribute value without its quotes; an absent attribute (``''``) is NULL."""
    closed = F.length(raw) > 1
    quoted = (raw.startswith('"') & raw.endswith('"')) | (raw.startswith("'") & raw.endswith("'"))
    return F.when(quoted & closed, raw.substr(F.lit(2), F.length(raw) - 2)).when(raw != "", raw)


def _named(found: Column, tag: str) -> Column:
    """Pieces that are such tags; no two names asked for begin alike."""
    return F.filter(found, lambda p: p.startswith(f"<{tag}"))


def _values(found: Column, tag: str, attribute: str) -> Column:
    """The attribute of every such tag that has it, unquoted and decoded.

    Extraction, unquoting and decoding are steps of their own, so each works on a
    bound variable and nothing is evaluated twice.
    """
    raw = F.transform(_named(found, tag), lambda p: F.regexp_extract(p, _attribute(tag, attribute), 1))
    return F.transform(F.transform(F.filter(raw, lambda v: v != ""), _unquoted), decode)


def hrefs(found: Column) -> Column:
    """All anchor targets among the pieces in document order, duplicates kept."""
    return _values(found, "a", "href")


def base_href(found: Column) -> Column:
    """Target of the first base tag that has one, else NULL."""
    return F.try_element_at(_values(found, "base", "href"), F.lit(1))


def anchor_count(found: Column) -> Column:
    """Number of anchors, with or without a target."""
    return F.size(_named(found, "a"))


_META_FIELDS = {"name": "name", "equiv": "http-equiv", "content": "content"}


def metas(found: Column) -> Column:
    """One struct (name, equiv, content) per meta tag, in document order."""

    def each(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda m: F.struct(*[step(m[field]).alias(field) for field in _META_FIELDS])

    def raw(tag: Column) -> Column:
        return F.struct(*[F.regexp_extract(tag, _attribute("meta", attr), 1).alias(field) for field, attr in _META_FIELDS.items()])

    return F.transform(F.transform(F.transform(_named(found, "meta"), raw), each(_unquoted)), each(decode))


def meta_content(tags: Column, name: str) -> Column:
    """Content of the last meta tag with this name."""
    named = F.filter(tags, lambda m: m["name"] == name)
    return F.try_element_at(named, F.lit(-1))["content"]


def meta_charset(tags: Column) -> Column:
    """Content of the last content-type tag that has no name."""
    typed = F.filter(tags, lambda m: m["name"].isNull() & (m["equiv"] == "content-type"))
    return F.try_element_at(typed, F.lit(-1))["content"]


def meta_keywords(tags: Column) -> Column:
    """Tokens of every keywords tag, in order."""
    named = F.filter(tags, lambda m: (m["name"] == "keywords") & m["content"].isNotNull())
    tokens = F.flatten(F.transform(named, lambda m: F.split(m["content"], r"[\s,*]+")))
    return F.coalesce(F.filter(tokens, lambda t: t != ""), F.array().cast("array<string>"))


def body_span(found: Column) -> Column:
    """Struct (n, begin, end): number of pieces, and the numbers of the first body tag and of the first end behind it; 0 is none.

    A fold over the pieces whose mode is where in the page it is: before, in or behind the body.
    """
    none = F.lit(0)

    def step(at: Column, piece: Column) -> Column:
        n = at["n"] + 1
        begins = (at["begin"] == 0) & piece.startswith("<body")
        ends = (at["begin"] > 0) & (at["end"] == 0) & piece.startswith("</body")
        return F.struct(n.alias("n"), F.when(begins, n).otherwise(at["begin"]).alias("begin"), F.when(ends, n).otherwise(at["end"]).alias("end"))

    return F.aggregate(found, F.struct(none.alias("n"), none.alias("begin"), none.alias("end")), step)


def body_text(found: Column, span: Column) -> Column:
    """Visible text of the body, chunks joined by one space; NULL when empty."""
    begin = F.when(span["begin"] > 0, span["begin"]).otherwise(span["n"])
    inside = F.slice(found, begin + 1, F.when(span["end"] > 0, span["end"] - 1).otherwise(span["n"]) - begin)
    texts = F.filter(inside, lambda p: ~p.rlike(r"\A</?(?:a|base|meta|body)[\s/>]"))
    around = rf"\A<(?:{'|'.join(SHOWN)})(?=[\s/>]){_INSIDE}>|</(?:{'|'.join(SHOWN)})\s*+>\z"
    shown = F.transform(texts, lambda p: F.when(p.rlike(r"\A<[a-z]"), F.regexp_replace(p, around, "")).otherwise(p))
    return F.nullif(F.trim(F.regexp_replace(F.array_join(shown, " "), WIDE_SPACE, " ")), F.lit(""))
