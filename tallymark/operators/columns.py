"""Choosing, dropping and recoding columns from the schema alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows where ``column`` equals ``value``; a frame without the column passes unchanged."""
    return df.filter(F.col(column) == value) if column in df.columns else df


def feature_names(df: DataFrame, excluded: list[str]) -> list[str]:
    return [c for c in df.columns if c not in excluded]


def features_and_target(df: DataFrame, target: str, excluded: list[str]) -> tuple[DataFrame, list[str]]:
    """Feature columns in order followed by the target as ``label``, and the list of feature names."""
    names = feature_names(df, [target, *excluded])
    return df.select(*names, F.col(target).alias("label")), names


def numeric_columns(df: DataFrame, excluded: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in excluded]


def categorical_columns(df: DataFrame, excluded: list[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (StringType, BooleanType)) and f.name not in excluded
    ]


def column_roles(df: DataFrame, categorical: list[str], target: str, excluded: list[str] = ()) -> list[tuple[str, str, str]]:
    """(column, role, type) with the roles target, categorical, numeric and ignored."""
    roles = []
    for field in df.schema.fields:
        if field.name in excluded:
            role = "ignored"
        elif field.name == target:
            role = "target"
        elif field.name in categorical:
            role = "categorical"
        else:
            role = "numeric"
        roles.append((field.name, role, field.dataType.simpleString()))
    return roles


def binarize(column: Column | str, above: float = 0) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return (column > above).cast("int")


def predict_at(score: Column | str, threshold: float | Column, strict: bool = False) -> Column:
    """1 where the score reaches the threshold (or exceeds it when ``strict``)."""
    score = F.col(score) if isinstance(score, str) else score
    return ((score > threshold) if strict else (score >= threshold)).cast("int")
