"""Tolerant text-to-type column functions; malformed text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts in order of preference, flag letter, tax-id width.
DATE_LAYOUTS = ("yyyy-MM-dd", "dd/MM/yyyy")
YES = "S"
CNPJ_DIGITS = 14


def mixed_date(c: Column) -> Column:
    return F.coalesce(*[F.try_to_date(c, layout) for layout in DATE_LAYOUTS])


def cnpj_digits(c: Column) -> Column:
    """Digits only, left-padded if short and never cut; not passed through a number, so leading zeros survive."""
    digits = F.regexp_replace(F.trim(c), "[^0-9]", "")
    return F.when(F.length(digits) < CNPJ_DIGITS, F.lpad(digits, CNPJ_DIGITS, "0")).otherwise(digits)


def title_text(c: Column) -> Column:
    return F.regexp_replace(F.initcap(F.trim(c)), " +", " ")


def is_true(c: Column) -> Column:
    """Two-valued boolean: NULL counts as false."""
    return F.coalesce(c, F.lit(False))


KINDS = {
    "text": F.trim,
    "title": title_text,
    "cnpj": cnpj_digits,
    "date": mixed_date,
    "flag": lambda c: is_true(F.trim(c) == YES),
    "absent": lambda c: c.isNull(),
    "int": lambda c: c.try_cast("int"),
    "money": lambda c: c.try_cast("decimal(18,2)"),
    "percent": lambda c: c.try_cast("decimal(5,2)"),
}


def typed_columns(rules: list[tuple[str, str, str]]) -> list[Column]:
    """One output column per (target, source, kind) rule."""
    return [KINDS[kind](F.col(source)).alias(target) for target, source, kind in rules]
