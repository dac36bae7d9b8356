"""Value expressions: recodes, guarded ratios, rounding, state lookups, null filling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics import config


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def recode(code: Column, labels: Mapping[str, str], default: str) -> Column:
    """Label of a code; any other code, and null, gets the default."""
    return F.coalesce(F.try_element_at(literal_map(labels), code), F.lit(default))


def recode_columns(
    df: DataFrame, tables: Mapping[str, tuple[Mapping[str, str], str]] = config.MORTALITY_CODES
) -> DataFrame:
    """Recode every column that has a code table and is present in ``df``."""
    return df.withColumns({c: recode(F.col(c), *table) for c, table in tables.items() if c in df.columns})


def remap_codes(code: Column, codes: Iterable[str], target: str) -> Column:
    """Replace the listed codes by ``target``; null stays null."""
    text = code.cast("string")
    return F.when(text.isin(list(codes)), F.lit(target)).otherwise(text)


def ratio(top: Column, bottom: Column, factor: float = 1.0) -> Column:
    """``top / bottom * factor``; null where the divisor is zero or null."""
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if factor == 1.0 else value * F.lit(factor)


def per_thousand(top: Column, bottom: Column) -> Column:
    return ratio(top, bottom, 1000.0)


def occupancy_rate(days: Column, beds: Column) -> Column:
    """Bed occupancy over a year in percent, two decimals; zero where there are no beds."""
    days, beds = F.coalesce(days, F.lit(0.0)), F.coalesce(beds, F.lit(0.0))
    return F.when(beds == 0, F.lit(0.0)).otherwise(F.round(ratio(days, beds * 365, 100.0), 2))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over columns of a row in which null counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in columns])


def fill_all(df: DataFrame) -> DataFrame:
    """Zero for every null: 0 in numeric columns, ``'0'`` in string columns."""
    return df.na.fill(0).na.fill("0")


def fill_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0.0 for nulls of the listed columns that are present."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in present})


def round_doubles(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every double column, halves to the even digit."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.bround(F.col(f"`{c}`"), digits) for c in doubles})


def region_of(state: Column) -> Column:
    """Region of a state; unknown or null states get their own label."""
    by_state = {uf: region for region, states in config.REGIONS.items() for uf in states}
    return recode(state, by_state, config.UNKNOWN_REGION)


def is_capital(name: Column, state: Column) -> Column:
    """Whether a municipality is the capital of its state; false when either is unknown."""
    return F.coalesce(name == F.try_element_at(literal_map(config.CAPITALS), state), F.lit(False))


def feature_subset(df: DataFrame, labels: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Label columns and features, keeping only those that exist."""
    return df.select(*[F.col(f"`{c}`") for c in [*labels, *features] if c in df.columns])


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]
