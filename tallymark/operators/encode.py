"""Category dictionaries: level codes in ascending text order, and one-hot columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ranking import bucket_count, with_row_number
from tallymark.session import attach, few_rows, written

MAX_ONE_HOT_LEVELS = 1_000


def fill_missing_level(column: Column, level: str | None) -> Column:
    """Text form of a category with nulls as their own level; ``None`` keeps nulls."""
    text = column.cast("string")
    return text if level is None else F.coalesce(text, F.lit(level))


def fit_dictionaries(df: DataFrame, columns: list[str], missing_level: str | None = None) -> dict[str, DataFrame]:
    """A dictionary ``level, code`` per column; code 0 is the first level in text order.

    All columns are read in one pass. When their levels together are few they are sorted at once; otherwise each
    column is ranked on the cluster.
    """
    pairs = _level_pairs(df, columns, missing_level)
    rows = few_rows(pairs)
    if rows is None:
        return {c: _rank_levels(pairs.filter(F.col("column") == c).select("level")) for c in columns}
    fitted = {}
    for c in columns:
        levels = _sorted_levels(rows, c)
        fitted[c] = df.sparkSession.createDataFrame(list(zip(levels, range(len(levels)))), "level string, code int")
    return fitted


def _level_pairs(df: DataFrame, columns: list[str], missing_level: str | None) -> DataFrame:
    """Distinct ``column, level`` of all columns from one pass."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), fill_missing_level(F.col(c), missing_level).alias("level")) for c in columns
    ])
    return df.select(F.explode(entries).alias("e")).select("e.*").filter("level is not null").distinct()


def _sorted_levels(rows: list, column: str) -> list[str]:
    return sorted((level for name, level in rows if name == column), key=str.encode)


def fit_dictionary(df: DataFrame, column: str, missing_level: str | None = None) -> DataFrame:
    return fit_dictionaries(df, [column], missing_level)[column]


def _rank_levels(levels: DataFrame) -> DataFrame:
    """Rank any number of distinct levels in range partitions of the text. They are written, so that their cuts are settled."""
    ranged = levels.repartitionByRange(bucket_count(levels), "level")
    bucketed = written(ranged.withColumn("__range", F.spark_partition_id()))
    numbered = with_row_number(bucketed, "rank", [F.col("level")], F.col("__range"))
    return numbered.select("level", (F.col("rank") - 1).cast("int").alias("code"))


def apply_dictionary(
    df: DataFrame, column: str, dictionary: DataFrame, missing_level: str | None = None, output: str | None = None
) -> DataFrame:
    """Replace levels by codes. A level that was not fitted, or a column that does not exist, is an error."""
    output = output or column
    keyed = df.withColumn("__level", fill_missing_level(F.col(column), missing_level))
    renamed = dictionary.select(F.col("level").alias("__level"), F.col("code").alias("__code"))
    joined = attach(keyed, renamed, ["__level"])
    unseen = F.col("__code").isNull() & F.col("__level").isNotNull()
    message = F.concat(F.lit(f"level of {column} was not fitted: "), F.col("__level"))
    code = F.when(unseen, F.raise_error(message).cast("int")).otherwise(F.col("__code"))
    return joined.withColumn(output, code).drop("__level", "__code")


def label_encode(df: DataFrame, columns: list[str], missing_level: str | None = "missing") -> DataFrame:
    """Fit and apply a dictionary for each column."""
    for column, dictionary in fit_dictionaries(df, columns, missing_level).items():
        df = apply_dictionary(df, column, dictionary, missing_level)
    return df


def decode(df: DataFrame, column: str, dictionary: DataFrame, output: str) -> DataFrame:
    """Codes back to their levels."""
    inverse = dictionary.select(F.col("code").alias(column), F.col("level").alias(output))
    return attach(df, inverse, [column])


def one_hot(df: DataFrame, columns: list[str], drop_first: bool = True) -> DataFrame:
    """One 0/1 column ``column_level`` per level, the first level in text order left out."""
    rows = few_rows(_level_pairs(df, columns, None))
    for column in columns:
        levels = None if rows is None else _sorted_levels(rows, column)
        if levels is None or len(levels) > MAX_ONE_HOT_LEVELS:
            raise ValueError(f"{column} has too many levels for columns of their own; use label_encode")
        text = F.col(column).cast("string")
        wide = {f"{column}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in levels[1 if drop_first else 0:]}
        df = df.withColumns(wide).drop(column) if wide else df.drop(column)
    return df
