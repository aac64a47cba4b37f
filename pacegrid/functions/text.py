"""Display text, text repair and extraction from stringly nested values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_name(first: Column, last: Column, fallback_id: Column | None = None) -> Column:
    """First and last name joined and trimmed; an empty name becomes the id if given."""
    name = F.trim(
        F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    )
    if fallback_id is None:
        return name
    return F.coalesce(F.nullif(name, F.lit("")), fallback_id.cast("string"))


def format_time(seconds: Column) -> Column:
    """``H:MM:SS`` from one hour, else ``M:SS``; half seconds round to even; NULL is ``-``."""
    total = F.bround(seconds.cast("double"), 0).cast("bigint")
    hours = F.floor(total / 3600)
    minutes = F.floor((total - hours * 3600) / 60)
    rest = total - hours * 3600 - minutes * 60
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    short = F.concat(minutes.cast("string"), F.lit(":"), two(rest))
    long = F.concat(hours.cast("string"), F.lit(":"), two(minutes), F.lit(":"), two(rest))
    return F.when(total.isNull(), F.lit("-")).when(hours != 0, long).otherwise(short)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled double to the nearest whole number, halves to even."""
    scale = 10**digits
    return F.rint(value * scale) / scale


def signed_pct(pct: Column) -> Column:
    """``+1.2%`` style text, empty where there is no percentage."""
    text = F.format_string("%+.1f%%", F.bround(pct, 1))
    return F.when(pct.isNull(), F.lit("")).otherwise(text)


def pace_label(seconds: Column, km: Column) -> Column:
    pace = format_time(F.try_divide(seconds, km))
    return F.concat(pace, F.lit("/km | "), F.format_string("%.1f km", F.bround(km, 1)))


def repair_latin1(text: Column) -> Column:
    """Undo UTF-8 text that was once decoded as Latin-1; leave all other text alone."""
    fits_latin1 = text.rlike("^[\\u0000-\\u00FF]*$")
    as_utf8 = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(fits_latin1, F.coalesce(as_utf8, text)).otherwise(text)


# Quoted texts, brackets and separators, bare words; anything else by itself.
_LITERAL_TOKEN = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^\s{}\[\],:'"]+|\S"""

# A whole dict whose only top-level ``id`` is a number, with flat dicts and lists inside. All
# repeats are possessive: a text is gone through once.
_S = r"[ \t\r\n]*+"
_QUOTED = r"""(?:'[^'\\]*+'|"[^"\\]*+")"""
_SCALAR = rf"(?:{_QUOTED}|-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?![\w.+-])|(?:None|True|False)\b)"
_FLAT_DICT = rf"\{{{_S}(?:{_QUOTED}{_S}:{_S}{_SCALAR}{_S}(?:,{_S}(?!\}})|(?=\}})))*+\}}"
_FLAT_LIST = rf"\[{_S}(?:{_SCALAR}{_S}(?:,{_S}(?!\])|(?=\])))*+\]"
_OTHER = rf"""(?!['"]id['"]){_QUOTED}{_S}:{_S}(?:{_SCALAR}|{_FLAT_DICT}|{_FLAT_LIST}){_S}"""
_PLAIN_DICT = (
    rf"""\A{_S}\{{{_S}(?:{_OTHER},{_S})*+['"]id['"]{_S}:{_S}(0|-?+[1-9][0-9]{{0,17}}+)(?![\w.+-])"""
    rf"{_S}(?:,{_S}{_OTHER})*+\}}{_S}\z"
)


def nested_id(literal: Column) -> Column:
    """The top-level ``id`` of a dict written as text, at any depth of nesting inside; NULL
    if there is none or if the text is not a whole dict."""
    # Most texts by one pattern; those it does not fit are parsed.
    quick = F.regexp_extract(literal, _PLAIN_DICT, 1).try_cast("bigint")
    return F.coalesce(quick, _parsed_id(literal))


def _parsed_id(literal: Column) -> Column:
    """``nested_id`` by rewriting the text as JSON."""

    def as_json(token: Column) -> Column:
        quoted = token.rlike(r"""(?s)^(?:'.*'|".*")$""") & (F.length(token) > 1)
        inner = F.regexp_replace(F.substring(token, F.lit(2), F.length(token) - 2), r"(?s)\\(.)", "$1")
        escaped = F.regexp_replace(inner, r"""(["\\])""", r"\\$1")
        return (
            F.when(quoted, F.concat(F.lit('"'), escaped, F.lit('"')))
            .when(token == "None", "null")
            .when(token.isin("True", "False"), F.lower(token))
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(literal, F.lit(_LITERAL_TOKEN), 0)
    # Without double quotes and escapes, every single quote bounds a text, and the words below
    # may be replaced inside texts too, as those are not looked at.
    plain = ~F.contains(literal, F.lit('"')) & ~F.contains(literal, F.lit("\\"))
    quick = F.regexp_replace(F.translate(literal, "'", '"'), r"\b(?:None|True|False)\b", "null")
    text = F.when(plain, quick).otherwise(F.array_join(F.transform(tokens, as_json), " "))
    # As a list of one, so that text behind the dict makes it malformed.
    text = F.concat(F.lit("["), text, F.lit("]"))
    found = F.from_json(text, "array<struct<id: bigint>>", {"allowUnquotedControlChars": "true"})
    return F.when(literal.rlike(r"^\s*\{") & (F.size(found) == 1), F.get(found, 0)["id"])


def utc_timestamp(text: Column) -> Column:
    """Parse ISO-8601 text under a UTC session; local times marked ``Z`` read as UTC too."""
    return F.try_to_timestamp(text)
