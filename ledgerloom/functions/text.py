"""Column expressions on text: splitting, cleaning, normalising, composing keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import EMAIL_PROVIDERS, US_SUFFIXES


def _split(c: Column, sep: str) -> Column:
    return F.split(c, rf"\Q{sep}\E")


def split_part(c: Column, sep: str, index: int) -> Column:
    """The ``index``-th piece (from 0), null when there is none."""
    return F.get(_split(c, sep), F.lit(index))


def resolution(c: Column, sep: str = "x") -> tuple[Column, Column, Column]:
    """``'1920x1080'`` as (width, height, text); a missing size is 0, 0 and null text."""
    empty = f"0{sep}0"
    filled = F.coalesce(c, F.lit(empty))
    width = split_part(filled, sep, 0).try_cast("int")
    height = split_part(filled, sep, 1).try_cast("int")
    return width, height, F.nullif(filled, F.lit(empty))


def status_code(c: Column, sep: str = ":") -> Column:
    """The number after the separator; 0 and missing both become null."""
    number = split_part(F.coalesce(c, F.lit(f"{sep}0")), sep, 1).try_cast("int")
    return F.nullif(number, F.lit(0))


def literal_map(c: Column, mapping: Mapping) -> Column:
    """Look the value up in a fixed dictionary; a miss is null."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def contains_rules(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Replace the whole text by the label of the first rule whose fragment it contains."""
    out = None
    for fragment, label in rules:
        hit = c.contains(fragment)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return c if out is None else out.otherwise(c)


def email_provider(c: Column) -> Column:
    """Provider of a mail domain; unknown domains are null."""
    return literal_map(c, EMAIL_PROVIDERS)


def domain_suffix(c: Column) -> Column:
    """Text after the last dot, the United States suffixes folded into ``'us'``."""
    last = F.element_at(_split(F.coalesce(c, F.lit("nan")), "."), -1)
    return F.when(last.isin(*US_SUFFIXES), "us").otherwise(last)


def letters_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}]", "")


def digits_only(c: Column) -> Column:
    """Numeric characters of any script, including superscripts and fractions."""
    return F.regexp_replace(c, r"[^\p{N}]", "")


def lower_default(c: Column, default: str = "unknown_device") -> Column:
    return F.lower(F.coalesce(c, F.lit(default)))


def concat_key(*cols: Column, sep: str = "_", null_text: str = "nan") -> Column:
    """Composite text key; a null member keeps its place as ``'nan'``."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in cols])
