"""Text of HTML, with regular expressions only.

An approximation of an HTML parser: markup is taken as written, and an anchor ends at its end tag or
where the next anchor begins. All named entities of the standard and numeric references of any length
are decoded, if they end in a semicolon.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
REST_OF_TAG = rf"(?:[^>=]++|=\s*+{VALUE}?+)*+>"
ANCHOR = rf"(?is)<a(?=\s){REST_OF_TAG}.*?(?=<a\s|</a\s*>|\z)"
OPEN_TAG = rf"(?is)^<a(?=\s){REST_OF_TAG}"
OTHER_ATTRIBUTES = rf"(?:[\s/]*+(?!href\s*=)[^\s=>/]++(?:\s*+=\s*+{VALUE}?+)?+)*+"
HREF = rf"""(?is)^<a{OTHER_ATTRIBUTES}[\s/]*+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)?)"""
TAG = r"<[^>]*>"
TEXT_BREAK = r"<!--|-->|<[^>]*>"
BREAK = "\u0001"

# The standard library's table of entities with their semicolon, as text of one literal.
NAMED = "\u0001".join(f"&{name}\u0002{text}" for name, text in html5.items() if name.endswith(";"))
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
# References to control characters stand for those that Windows has there.
WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _character(reference: Column) -> Column:
    """Character of a reference's digits such as ``8364`` or ``x20ac``, however many zeros they begin with."""
    hexadecimal = F.lower(F.left(reference, F.lit(1))) == "x"
    digits = F.regexp_replace(F.when(hexadecimal, F.substr(reference, F.lit(2))).otherwise(reference), "^0+(?=.)", "")
    # eight digits are enough to be beyond the last character
    short = F.when(F.length(digits) > 8, F.lit("99999999")).otherwise(digits)
    code = F.when(hexadecimal, F.conv(short, 16, 10)).otherwise(short).cast("bigint")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    plain = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    return F.when(code.between(0x80, 0x9F), F.substr(F.lit(WINDOWS), (code - 0x7F).cast("int"), F.lit(1))).otherwise(plain)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _decoded(reference: Column) -> Column:
    """Text of one reference; a name that is not in the table stays as it is."""
    table = F.str_to_map(F.lit(NAMED), F.lit("\u0001"), F.lit("\u0002"))
    body = F.substr(reference, F.lit(3), F.length(reference) - 3)
    return F.when(reference.startswith("&#"), _character(body)).otherwise(F.coalesce(F.try_element_at(table, reference), reference))


def _decode(text: Column) -> Column:
    """The pieces between the references and each reference's text, in turn, so nothing is decoded twice."""
    return _let(
        F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)),
        lambda references: F.array_join(
            F.flatten(
                F.zip_with(
                    F.split(text, REFERENCE, -1), references, lambda piece, ref: F.array(piece, F.coalesce(_decoded(ref), F.lit("")))
                )
            ),
            "",
        ),
    )


def decode_entities(text: Column) -> Column:
    return _let(text, lambda t: F.when(t.contains("&"), _decode(t)).otherwise(t))


def strip(text: Column) -> Column:
    """Without white space at both ends, no-break spaces included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def anchors(html: Column) -> Column:
    """Every anchor with its content, in document order."""
    return F.regexp_extract_all(F.regexp_replace(html, NOT_MARKUP, ""), F.lit(ANCHOR), F.lit(0))


def has_href(anchor: Column) -> Column:
    return anchor.rlike(HREF)


def href(anchor: Column) -> Column:
    return decode_entities(F.concat(*[F.regexp_extract(anchor, HREF, group) for group in (1, 2, 3)]))


def anchor_text(anchor: Column) -> Column:
    """The text pieces between the tags, each stripped, joined by one space."""
    pieces = F.transform(F.split(F.regexp_replace(anchor, OPEN_TAG, ""), TAG), lambda p: strip(decode_entities(p)))
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def text_pieces(html: Column) -> Column:
    """All text of a page as one string, pieces of different elements kept apart."""
    return decode_entities(F.regexp_replace(html, TEXT_BREAK, BREAK))
