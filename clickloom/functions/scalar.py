"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickloom.constants import EFFECT_CUTS, SEED


def ratio(a: Column, b: Column, default: Column | float | None = None) -> Column:
    """``a / b``; ``default`` where ``b`` is zero or either side is null."""
    value = a / F.nullif(b.cast("double"), F.lit(0.0))
    return value if default is None else F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def six(c: Column) -> Column:
    """Round to six decimals and turn -0.0 into 0.0."""
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def unknown_code(c: Column) -> Column:
    """Integer code as text; null and -1 become "unknown"; a fractional code is an error."""
    whole = c.cast("bigint")
    checked = F.when(c.isNull() | (whole == c), whole).otherwise(
        F.raise_error(F.lit("code is not a whole number")).cast("bigint")
    )
    return F.coalesce(F.nullif(checked.cast("string"), F.lit("-1")), F.lit("unknown"))


def category_text(c: Column) -> Column:
    """Categorical value as text, null as "-1"."""
    return F.coalesce(c.cast("string"), F.lit("-1"))


def hash32(*parts: Column | str) -> Column:
    """The first 32 bits of an md5 over the parts joined by ':', as bigint."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def fold_of(row_id: Column, folds: int = 5, seed: int = SEED) -> Column:
    return F.pmod(hash32(str(seed), row_id.cast("string")), F.lit(folds)).cast("int")


def uniform_of(*parts: Column | str) -> Column:
    """Reproducible uniform number in [0, 1)."""
    return hash32(*parts).cast("double") / F.lit(4294967296.0)


def smoothed(clicks: Column, n: Column, prior: Column, weight: float) -> Column:
    return (clicks + prior * F.lit(float(weight))) / (n + F.lit(float(weight)))


def effect_label(delta: Column) -> Column:
    size = F.abs(delta)
    label = F.lit("Large")
    for bound, name in reversed(EFFECT_CUTS):
        label = F.when(size < bound, F.lit(name)).otherwise(label)
    return label
