"""Cleaning and categorising columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import AGE_BAND_DEFAULT, AGE_BANDS, BMI_CUTS, BMI_DEFAULT, MISSING_TOKENS


def is_token(c: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """True where the value, written as text, is one of the missing-value tokens in any case."""
    return F.lower(c.cast("string")).isin(*tokens)


def null_tokens(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Replace missing-value tokens by NULL; a double NaN counts as one, because its text is `NaN`."""
    return df.withColumns({c: F.when(is_token(F.col(c), tokens), None).otherwise(F.col(c)) for c in cols})


def find_tokens(df: DataFrame, col: str, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Rows whose column holds a missing-value token."""
    return df.where(is_token(F.col(col), tokens))


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns, giving NULL where the text is malformed. Run `null_tokens` first: 'nan' casts to a double NaN."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Strict cast: malformed text raises under ANSI mode."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def normalize_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim and lower-case text columns."""
    return df.withColumns({c: F.lower(F.trim(F.col(c))) for c in cols})


def band(c: Column, bins: Sequence[tuple] = AGE_BANDS, default: str = AGE_BAND_DEFAULT) -> Column:
    """Label of the first band that holds the number, both ends included; NULL, NaN and gaps get the default."""
    label = F.lit(default)
    for low, high, name in reversed(bins):
        label = F.when(c.between(low, high), name).otherwise(label)
    return label


def threshold(
    c: Column,
    cuts: Sequence[tuple] = BMI_CUTS,
    default: str = BMI_DEFAULT,
    null_label: str | None = None,
) -> Column:
    """Label of the first cut-off the number is below, else the default.

    NULL and NaN are below no cut-off and fall to the default; pass `null_label` to set them apart.
    """
    label = F.lit(default)
    for cut, name in reversed(cuts):
        label = F.when(c < cut, name).otherwise(label)
    if null_label is not None:
        label = F.when(c.isNull() | F.isnan(c.cast("double")), null_label).otherwise(label)
    return label


def pick_by_modulo(id_col: Column, labels: Sequence) -> Column:
    """Round-robin label: `labels[id % len(labels)]`."""
    return F.element_at(F.array(*[F.lit(v) for v in labels]), (F.pmod(id_col, F.lit(len(labels))) + 1).cast("int"))
