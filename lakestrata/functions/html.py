"""Attributes of the tags of a web page, in built-in functions.

As a parser sees them: what stands in comments, scripts, styles and other plain
text elements is no tag, a name's letter case doesn't matter, a value may be quoted either way or
not at all, the first of two attributes of one name counts, and entities are decoded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: A comment, or an element whose content is plain text: its tag, and what it holds.
_PLAIN = rf"(?is)<!--.*?(?:-->|$)|(<(script|style|textarea|title|xmp|iframe|noembed|noframes)\b{_QUOTED}>).*?(?:</\2\s*>|$)"
_TAG = rf"<[A-Za-z]{_QUOTED}>"
_ATTRIBUTE = r"""[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+))?"""
_NUMBER = r"&#(?:[xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});"

# The named entities that stand for markup, and the blank; the ampersand last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def _character(entity: Column) -> Column:
    """The character of a numeric entity; the replacement character where there is none of that number."""
    digits = F.substring(entity, F.lit(3), F.length(entity) - 3)
    hexadecimal = F.lower(F.substring(digits, 1, 1)) == "x"
    number = F.when(hexadecimal, F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits).cast("long")
    real = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(real, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")


def decoded(text: Column) -> Column:
    """``text`` with its entities replaced: numeric ones, and those of ``ENTITIES``."""
    parts, numbers = F.split(text, _NUMBER, -1), F.regexp_extract_all(text, F.lit(_NUMBER), F.lit(0))
    named = F.transform(parts, lambda x: reduce(lambda t, e: F.replace(t, F.lit(e), F.lit(ENTITIES[e])), ENTITIES, x))
    both = F.zip_with(named, numbers, lambda x, n: F.concat(x, F.when(n.isNull(), "").otherwise(_character(n))))
    return F.array_join(both, "")


def tags(html: Column) -> Column:
    """All tags of a page, as they stand."""
    return F.regexp_extract_all(F.regexp_replace(html, F.lit(_PLAIN), F.lit("$1")), F.lit(_TAG), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """A tag's value of an attribute, decoded; NULL without one."""
    all_ = F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]*", ""), F.lit(_ATTRIBUTE), F.lit(0))
    named = F.filter(all_, lambda a: F.lower(F.regexp_extract(a, r"^([^\s=]+)", 1)) == name.lower())
    value = F.regexp_extract(F.get(named, F.lit(0)), r"""(?s)^[^\s=]+\s*=\s*(?:"(.*)"|'(.*)'|(.*))$""", 0)
    bare = F.regexp_replace(value, r"(?s)^[^\s=]+\s*=\s*", "")
    quoted = bare.rlike(r"""(?s)^(".*"|'.*')$""")
    return decoded(F.when(quoted, F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare))


def attributes(html: Column, name: str) -> Column:
    """The values of an attribute in all tags of a page, in order."""
    return F.filter(F.transform(tags(html), lambda t: attribute(t, name)), lambda v: v.isNotNull() & (v != ""))
