"""Anchors of HTML text and character references."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortline.functions.values import let

# A start tag behind its name: quoted values hide a ``>``.
_BODY = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>=]|=)*+"""
# What a tokenizer meets at a ``<``, in the order in which it decides; each construct is taken
# whole, so an anchor inside a comment, a script or a quoted value is none. A comment or section
# that is never closed ends at the next ``>``, a script at the end of the text.
TOKENS = "(?is)" + "|".join([
    r"<!--(?:.*?--\s*>|[^>]*>)",
    r"<!\[\s*(?:if|else|endif)\b(?:.*?\]\s*>|[^>]*>)",
    r"<!\[(?:.*?\]\s*\]\s*>|[^>]*>)",
    r"<[!?/][^>]*>",
    rf"""<(script|style)(?=[\s/>]){_BODY}(?<![\s"']/)(?<!<script/)(?<!<style/)>.*?(?:</\s*\1\s*>|\z)""",
    rf"<a(?=[\s/])({_BODY})>",
    rf"<[a-z]{_BODY}>",
])
_ATTRIBUTE = r"""([^\s/>][^\s/=>]*)(?:\s*=+\s*("[^"]*"|'[^']*'|(?!["'])[^\s>]*))?"""


def anchor_hrefs(text: Column) -> Column:
    """Array of the ``href`` values of every ``<a>`` tag, references decoded. The last of several
    counts; one without a value is empty."""
    bodies = F.filter(F.regexp_extract_all(text, F.lit(TOKENS), 2), lambda b: b.rlike(r"(?i)href"))

    def values(body: Column) -> Column:
        pairs = F.arrays_zip(F.regexp_extract_all(body, F.lit(_ATTRIBUTE), 1).alias("name"),
                             F.regexp_extract_all(body, F.lit(_ATTRIBUTE), 2).alias("value"))
        mine = F.filter(pairs, lambda p: F.lower(p["name"]) == "href")
        return F.transform(F.slice(F.reverse(mine), 1, 1), lambda p: unquoted(p["value"]))

    return F.transform(F.flatten(F.transform(bodies, values)), decode_references)


def unquoted(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _named() -> Column:
    """Names (with or without the semicolon that they are written with) and their text."""
    return F.from_json(F.lit(json.dumps(html.entities.html5)), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a numeric reference: bytes 0x80 to 0x9F mean Windows-1252, what no text
    can hold becomes U+FFFD or nothing."""
    windows = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")
    table = F.array(*[F.lit(chr(0x80 + i) if c == "�" else c) for i, c in enumerate(windows)])
    low = code % 65536
    nothing = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
               | (low >= 0xFFFE))
    encoded = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), "�")
            .when(code.between(0x80, 0x9F), F.element_at(table, (code - 0x7F).cast("int")))
            .when(nothing, "").otherwise(encoded))


_REFERENCE = "^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <#;]{1,32};?)"


def _numeric(found: Column) -> Column:
    digits = F.regexp_replace(F.regexp_extract(found, "^#[xX]?([0-9a-fA-F]+)", 1), "^0+(?=.)", "")
    code = let(digits, lambda d: F.when(F.length(d) > 9, F.lit(0x110000).cast("long")).when(
        found.rlike("^#[xX]"), F.conv(d, 16, 10).cast("long")).otherwise(F.conv(d, 10, 10).cast("long")))
    return let(code, _character)


def _reference(part: Column, named: Column) -> Column:
    """The text of what stood behind a ``&``."""
    def by_name(found: Column) -> Column:
        # a name without its semicolon may run into the text: the longest known start of it counts
        known = F.reduce(
            F.reverse(F.sequence(F.lit(2), F.greatest(F.length(found), F.lit(2)))), F.lit(None).cast("int"),
            lambda best, n: F.coalesce(best, F.when(F.map_contains_key(named, F.substr(found, F.lit(1), n)), n)))
        return let(known, lambda n: F.when(n.isNull(), F.concat(F.lit("&"), found)).otherwise(F.concat(
            F.try_element_at(named, F.substr(found, F.lit(1), n)), F.substr(found, n + 1))))

    return let(F.regexp_extract(part, _REFERENCE, 1), lambda found: F.when(found == "", F.concat(F.lit("&"), part)).otherwise(
        F.concat(F.when(found.startswith("#"), _numeric(found)).otherwise(by_name(found)), F.substr(part, F.length(found) + 1))))


def decode_references(text: Column) -> Column:
    """Named and numeric character references replaced by what they stand for."""
    def decoded(parts: Column) -> Column:
        texts = let(_named(), lambda named: F.transform(
            F.slice(parts, F.lit(2), F.size(parts)), lambda p: _reference(p, named)))
        return F.concat(parts[0], F.array_join(texts, ""))

    return F.when(text.contains("&"), let(F.split(text, "&"), decoded)).otherwise(text)
