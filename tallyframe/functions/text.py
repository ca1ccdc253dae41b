"""Text helpers whose meaning differs from the Spark built-in."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """Null, empty or only spaces. Never null itself."""
    return F.coalesce(F.trim(c.cast("string")) == "", F.lit(True))


def key_text(c: Column, case: str = "upper", trim: bool = True) -> Column:
    """Comparable form of a key: text, trimmed, in one case."""
    out = c.cast("string")
    if trim:
        out = F.trim(out)
    if case == "upper":
        return F.upper(out)
    if case == "lower":
        return F.lower(out)
    if case == "preserve":
        return out
    raise ValueError("case must be upper, lower or preserve")


def left_part(c: Column, n: Column | int) -> Column:
    return F.left(c, F.lit(n) if isinstance(n, int) else n)


def right_part(c: Column, n: Column | int) -> Column:
    return F.right(c, F.lit(n) if isinstance(n, int) else n)


left_substr = left_part
right_substr = right_part


def mid(c: Column, start: int, length: int) -> Column:
    """``length`` characters from the 1-based ``start``."""
    return F.substring(c, start, length)


def pad_left(c: Column, width: int, pad: str = " ") -> Column:
    """Pad on the left; a longer value stays whole."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def pad_right(c: Column, width: int, pad: str = " ") -> Column:
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, pad))


def str_pos(c: Column, part: str) -> Column:
    """1-based position, -1 when absent."""
    at = F.instr(c, F.lit(part))
    return F.when(at == 0, F.lit(-1)).otherwise(at)


def search(c: Column, part: str) -> Column:
    """1-based position without regard to case, -1 when absent."""
    return str_pos(F.lower(c), part.lower())


def regex_extract(c: Column, pattern: str, group: int | None = None) -> Column:
    """First capture group if the pattern has one, else the whole match; null without a match."""
    if group is None:
        group = 1 if re.compile(pattern).groups else 0
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, group))


def regex_search(c: Column, pattern: str, start: int = 1) -> Column:
    """1-based position of the first match at or after ``start``, -1 when absent."""
    at = F.regexp_instr(F.substring(c, start, 2147483647), F.lit(pattern))
    return F.when(at == 0, F.lit(-1)).otherwise(at + F.lit(start - 1))


# Characters and their HTML entities, in the order they are escaped.
HTML_ENTITIES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")]


def escape_html(c: Column) -> Column:
    for char, entity in HTML_ENTITIES:
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def unescape_html(c: Column) -> Column:
    for char, entity in reversed(HTML_ENTITIES):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def base64_encode(c: Column) -> Column:
    # one line: Spark breaks base64 text every 76 characters
    return F.translate(F.base64(c.cast("binary")), "\r\n", "")


def base64_decode(c: Column) -> Column:
    return F.unbase64(c).cast("string")


def hash_text(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def replace_literal(c: Column, find: str, replacement: str, case_sensitive: bool = True, whole_word: bool = False) -> Column:
    """Replace a literal text; word boundaries and case are options."""
    if case_sensitive and not whole_word:
        return F.replace(c, F.lit(find), F.lit(replacement))
    pattern = "".join("\\" + ch if not ch.isalnum() and ch not in " _" else ch for ch in find)
    if whole_word:
        pattern = rf"(?<!\w){pattern}(?!\w)"
    if not case_sensitive:
        pattern = "(?iu)" + pattern
    return F.regexp_replace(c, F.lit(pattern), F.lit(replacement.replace("\\", "\\\\").replace("$", "\\$")))


def json_field(c: Column, path: str) -> Column:
    """Text value at a JSON path; null for bad JSON."""
    return F.get_json_object(c, path if path.startswith("$") else "$." + path)


def json_format(c: Column) -> Column:
    """Canonical JSON text; null for bad JSON."""
    return F.to_json(F.try_parse_json(c))


def json_set(c: Column, key: str, value: Column) -> Column:
    """Set one top-level key of a JSON object, keeping every other value as it is."""
    parsed = F.from_json(c, "map<string,variant>")
    kept = F.map_filter(parsed, lambda k, _: k != F.lit(key))
    entry = F.create_map(F.lit(key), F.try_parse_json(F.to_json(F.struct(value.alias("v")))))
    entry = F.transform_values(entry, lambda _, v: F.variant_get(v, "$.v", "variant"))
    return F.when(parsed.isNotNull(), F.to_json(F.map_concat(kept, entry)))
