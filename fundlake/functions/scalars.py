"""Column functions (X01-X17), all built from Spark's own expressions so they
stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the non-breaking hyphen printed before negative percentages.
NB_HYPHEN = "‑"


def nullif_value(c: Column, value: str = "") -> Column:
    """NULLIF(c, value)."""
    return F.nullif(c, F.lit(value))


def contains_ci(c: Column, s: str) -> Column:
    """lower(c) contains lower(s)."""
    return F.lower(c).contains(s.lower())


def issuer_issue(desc: Column) -> tuple[Column, Column]:
    """First whitespace token is the issuer; last token is the issue
    when there is more than one token, else ''."""
    toks = F.split(F.trim(desc), r"\s+")
    n = F.size(toks)
    has = F.trim(desc) != F.lit("")
    issuer = F.when(has, F.element_at(toks, 1)).otherwise(F.lit(""))
    issue = F.when(has & (n > 1), F.element_at(toks, -1)).otherwise(F.lit(""))
    return issuer, issue


def parse_amount(c: Column, type_text: str = "decimal(21,6)") -> Column:
    """Printed amount -> number: thousands commas out, ``(1,004)`` and a
    leading hyphen or U+2011 are negative. Unparsable text -> NULL."""
    t = F.trim(c)
    neg = t.startswith("(") & t.endswith(")") | t.startswith("-") | t.startswith(NB_HYPHEN)
    digits = F.translate(t, "(), \t-" + NB_HYPHEN, "")
    v = F.nullif(digits, F.lit("")).try_cast(type_text)
    return F.when(neg, -v).otherwise(v)


def non_negative(c: Column) -> Column:
    """max(0, x)."""
    return F.greatest(F.lit(0), c)


def round_to(c: Column, scale: int, type_text: str | None = None) -> Column:
    """X11: half-up rounding on an exact decimal (cast first)."""
    t = type_text or f"decimal(38,{max(scale, 10)})"
    return F.round(c.cast(t), scale)


def fixed_text(c: Column, scale: int = 8) -> Column:
    """``%.8f``-style text."""
    return F.format_string(f"%.{scale}f", c)


def grouped_text(c: Column, scale: int = 2) -> Column:
    """Thousands-separated text."""
    return F.format_number(c, scale)


def comparable_text(c: Column, type_text: str | None = None) -> Column:
    """fillna('') + string, after an optional cast to one decimal type so
    2.47 and 2.4700 compare equal."""
    v = c.try_cast(type_text) if type_text else c
    return F.coalesce(v.cast("string"), F.lit(""))


def stamp(ts: Column) -> Column:
    """yyyyMMdd_HHmmss."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def file_name(path: Column) -> Column:
    """Basename of a path."""
    return F.element_at(F.split(path, "/"), -1)


def error_text(msg: Column, context: Column, width: int = 128) -> Column:
    """CONCAT + IFNULL + LEFT."""
    return F.left(F.concat(F.ifnull(context, F.lit("")), F.lit(": "), F.ifnull(msg, F.lit(""))),
                  F.lit(width))
