"""Text functions: flat text from HTML (P5), HTTP body split (P4 column
form), non-blank (F7) and length (F8) filters, document records (P9).

P5 is a chain of native expressions, so extraction never leaves the JVM (the
lambdas of reference decoding run outside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlsieve.functions.cdx import UNICODE_SPACE_CLASS

def _references() -> dict[str, str]:
    """Rule: every named character reference of HTML (from the Python standard
    library's table), with its ';' where it has one."""
    from html.entities import html5
    return dict(html5)


REFERENCES = _references()
# names that count without their ';', even as the beginning of a longer word
LEGACY = sorted((n for n in REFERENCES if not n.endswith(";")), key=lambda n: (-len(n), n))
# Numeric references to C1 controls 0x80-0x9F that HTML
# decodes as the Windows-1252 character instead (code point -> code point).
C1_REMAP = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020,
    0x87: 0x2021, 0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152,
    0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022,
    0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A,
    0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178,
}
# One pattern for every reference; group 1 is the body with its optional ';'.
REFERENCE_RE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
_LEGACY_RE = "^(?:" + "|".join(LEGACY) + ")"

NON_SPACE_RE = "[^" + UNICODE_SPACE_CLASS[1:]
# The rest of a tag after its name: attributes, whose quotes count only as the
# start of a value, up to the first '>' outside them; a value that is never closed
# runs to the end of the page, as in HTML.  Possessive, so nothing is tried twice.
_TAG_REST = r"""(?:[\s/](?:[\s/]++|[^\s>/=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+))?+|[^>])*+)?(?:>|\z)"""


def _element(name: str, content: str) -> str:
    """An element whose content is not markup, up to its own end tag."""
    return rf"<{name}{_TAG_REST}{content}(?:</{name}(?:[\s/][^>]*+)?(?:>|\z)|\z)"


# Script and style subtrees, comments, tags and doctype/processing instructions
# removed in one left-to-right pass: whatever starts first wins, so a tag inside a
# comment or script goes with its container; an element left open at the end of a
# truncated page runs to the end.  Element names end at a blank, '/' or '>', so
# <script-box> is an ordinary tag.  The contents of <textarea> and <title> are text,
# tags included (groups 1 and 2).
SCRUB_RE = ("(?is)" + "|".join([
    _element("script", ".*?"), _element("style", ".*?"), _element("textarea", "(.*?)"), _element("title", "(.*?)"),
    r"<!--(?:-?>|.*?(?:--!?>|\z))",
    r"</?[a-z][^\s/>]*+" + _TAG_REST,
    r"<[!?][^>]*+(?:>|\z)", r"</[^a-z>][^>]*+(?:>|\z)"]))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _named(body: Column) -> Column:
    """Characters of a name; the table is looked up by first letter, then name."""
    by_first: dict[str, list[Column]] = {}
    for name, chars in sorted(REFERENCES.items()):
        by_first.setdefault(name[0], []).extend([F.lit(name), F.lit(chars)])
    table = F.create_map(*[x for first, pairs in by_first.items() for x in (F.lit(first), F.create_map(*pairs))])
    return F.try_element_at(F.try_element_at(table, F.substring(body, 1, 1)), body)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element
    ``transform``): an expression may then use it several times without
    re-evaluating it, whatever operator the expression lands in."""
    return F.get(F.transform(F.array(value), body), 0)


def _reference_char(ref: Column) -> Column:
    """Text of one matched reference body (``#39;``, ``#x2019``, ``amp;``): a
    character, a legacy name's character and what follows it, or itself."""
    remap = F.create_map(*[F.lit(x) for kv in C1_REMAP.items() for x in kv])

    def numeric(body):
        is_hex = F.startswith(F.lower(body), F.lit("#x"))
        digits = F.regexp_replace(F.regexp_replace(body, "^#[xX]?0*", ""), ";$", "")
        small = F.when(is_hex, F.conv(F.substring(digits, 1, 8), 16, 10)).otherwise(F.substring(digits, 1, 8)).try_cast("long")
        # more than 7 digits without leading zeros is no code point in either base
        n = F.when(F.length(digits) <= 7, F.coalesce(small, F.lit(0).cast("long"))).otherwise(F.lit(-1).cast("long"))

        def to_char(n):
            valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
            cp = F.when(valid, n).otherwise(F.lit(0xFFFD))
            return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")

        return _let(F.coalesce(F.try_element_at(remap, n), n), to_char)

    def legacy(body):
        name = F.regexp_extract(body, _LEGACY_RE, 0)
        return F.when(name != "", F.concat(_named(name), F.substring(body, F.length(name) + 1, F.lit(2147483647)))) \
                .otherwise(F.concat(F.lit("&"), body))

    return F.when(F.startswith(ref, F.lit("#")), numeric(ref)).otherwise(F.coalesce(_named(ref), legacy(ref)))


def decode_entities(c) -> Column:
    """Decode named and numeric character references in one left-to-right
    pass (each reference once: ``&amp;#39;`` stays ``&#39;``).

    The text is split on the reference pattern, every match is mapped to
    its character, and the pieces are zipped back together; all native.
    The input is bound once (``_let``), so an expensive input expression
    is evaluated once per row.
    """
    def decode(x):
        pieces = F.split(x, REFERENCE_RE)
        chars = F.transform(F.regexp_extract_all(x, F.lit(REFERENCE_RE), 1), _reference_char)
        joined = F.array_join(
            F.zip_with(pieces, F.concat(chars, F.array(F.lit(""))),
                       lambda p, ch: F.concat(F.coalesce(p, F.lit("")), F.coalesce(ch, F.lit("")))), "")
        return F.when(F.contains(x, F.lit("&")), joined).otherwise(x)

    return _let(_c(c), decode)


def collapse_whitespace(c) -> Column:
    """Runs of Unicode whitespace -> one space, then trimmed."""
    return F.trim(F.regexp_replace(_c(c), UNICODE_SPACE_CLASS + "+", " "))


def flat_text(html) -> Column:
    """P5: drop script/style/comments, concatenate all text, collapse blanks."""
    h = F.regexp_replace(_c(html), SCRUB_RE, "$1$2")
    return F.coalesce(collapse_whitespace(decode_entities(h)), F.lit(""))


def with_computed(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add an expensive column computed exactly once per row.

    Filters on a plain projected column are pushed below the projection
    with the expression substituted, which would run the extraction chain
    once per predicate.  Producing the value through a one-element
    ``explode`` (a Generate node) keeps later predicates above it.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def is_nonblank(c) -> Column:
    """at least one non-whitespace character (NULL -> false)."""
    return F.coalesce(_c(c).rlike(NON_SPACE_RE), F.lit(False))


def length_ok(c, min_chars: int = 500, max_chars: int = 1_000_000) -> Column:
    """F8: code-point length within [min, max], both inclusive, unstripped."""
    return F.coalesce(F.length(_c(c)).between(min_chars, max_chars), F.lit(False))


def filter_nonblank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(is_nonblank(text))


def filter_length(df: DataFrame, text: str = "text", min_chars: int = 500,
                  max_chars: int = 1_000_000) -> DataFrame:
    return df.where(length_ok(text, min_chars, max_chars))


def http_body(raw) -> Column:
    """P4 (column form): text after the first blank line of an HTTP message.

    The earliest of CRLF CRLF or LF LF ends the head; the body starts after
    the matched separator.  No separator -> NULL.
    """
    return http_split(raw)[1]


def http_split(raw) -> tuple[Column, Column]:
    """(head, body) of an HTTP message held as text; both NULL without separator."""
    r = _c(raw)
    m = F.regexp_extract(r, r"(?s)^(.*?)(\r\n\r\n|\n\n)", 0)
    found = F.length(m) > 0
    head = F.regexp_extract(r, r"(?s)^(.*?)(\r\n\r\n|\n\n)", 1)
    body = F.substring(r, F.length(m) + 1, F.lit(2147483647))
    return (F.when(found, head), F.when(found, body))


def document_records(df: DataFrame, surt: str = "surt_url", ts: str = "timestamp",
                     text: str = "full_text", tokens: str | None = "tokens",
                     filename: str = "filename", keep=()) -> DataFrame:
    """The 7-column document record (or 6 without tokens), then the columns to keep."""
    cols = [F.coalesce(F.col(surt), F.lit("unknown")).alias("url"),
            F.coalesce(F.col(ts), F.lit("unknown")).alias("timestamp"),
            F.col(text).alias("full_text")]
    if tokens:
        cols += [F.col(tokens).alias("tokens"), F.size(tokens).cast("int").alias("token_count")]
    cols += [F.length(text).cast("int").alias("char_count"), F.col(filename).alias("filename")]
    return df.select(*cols, *keep)
