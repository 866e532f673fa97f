"""Small column expressions shared by many operators."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Validation patterns of the public forms.
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
MOBILE_PATTERN = r"^\+?[0-9]{10,15}$"
MOBILE_NOISE = r"[\s()-]"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_email(c: str | Column) -> Column:
    """Comparison form of an address: trimmed, lower case."""
    return F.lower(F.trim(col(c)))


def norm_phone(c: str | Column, default_country: str = "1") -> Column:
    """``+`` and digits; a bare ten-digit number gets the default country code."""
    digits = F.regexp_replace(col(c), r"[^0-9]", "")
    return F.when(F.length(digits) == 0, F.lit(None).cast("string")).when(
        F.length(digits) == 10, F.concat(F.lit("+" + default_country), digits)
    ).otherwise(F.concat(F.lit("+"), digits))


def joined(*parts: str | Column) -> Column:
    """Concatenation that treats NULL as the empty string (plain str = literal)."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def blank(c: str | Column) -> Column:
    return col(c).isNull() | (col(c) == "")


def or_default(c: str | Column, default: str) -> Column:
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def truthy(c: str | Column) -> Column:
    """Boolean read that also accepts the text forms true/false/1/0."""
    text = F.lower(F.trim(col(c).cast("string")))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))


def pct(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """``100 * n / d`` as double, NULL for an empty denominator."""
    return F.round(
        F.lit(100.0) * numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), digits
    )


def bands(value: Column, cuts: list[tuple[float, str]], otherwise: str | None) -> Column:
    """Searched CASE over descending lower bounds."""
    expr = None
    for bound, label in cuts:
        expr = F.when(value >= bound, label) if expr is None else expr.when(value >= bound, label)
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr


def by_prefix(value: Column, prefixes: list[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first literal prefix that matches."""
    expr = None
    for prefix, label in prefixes:
        hit = value.startswith(prefix)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(otherwise)


def mapped(value: Column, table: dict[str, str], otherwise: Column) -> Column:
    """CASE value WHEN key THEN literal … ELSE otherwise."""
    expr = None
    for key, result in table.items():
        expr = F.when(value == key, result) if expr is None else expr.when(value == key, result)
    return expr.otherwise(otherwise)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def is_true(c: str | Column) -> Column:
    """False instead of NULL, so that a negated test keeps unknown rows visible."""
    return F.coalesce(col(c), F.lit(False))


def effective_price(price: str = "Price", sale: str = "SalePrice", *, below_price: bool = True) -> Column:
    """Price a shopper sees: the sale price when it applies, else the list price."""
    applies = F.col(sale) > 0
    if below_price:
        applies = applies & (F.col(sale) < F.col(price))
    return F.when(applies, F.col(sale)).otherwise(F.col(price))


def display_money(c: str | Column) -> Column:
    return F.format_number(col(c).cast("decimal(18,2)"), 2)


def split_path(key: Column, salt: Column, share: int = 50) -> Column:
    """True for about ``share`` percent of keys, fixed for a given key and salt.

    MD5 rather than an engine-specific hash, so that any system can repeat the split.
    """
    head = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), salt.cast("string"))), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(100)) < share
