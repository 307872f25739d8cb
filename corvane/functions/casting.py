"""Typed projections of text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Select the named columns in order, each cast; text that does not fit becomes null."""
    return df.selectExpr(*[f"try_cast(`{name}` AS {kind}) AS `{name}`" for name, kind in types.items()])
