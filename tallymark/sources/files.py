"""Catalogues of files, built from their paths only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, glob: str = "*.bmp") -> DataFrame:
    """Paths below ``root`` that match ``glob``; file contents are never read because the column is pruned."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .load(root).select("path", "length")
    )


def bare_path(path: Column) -> Column:
    """Path without query, fragment and trailing slash."""
    return F.regexp_replace(F.regexp_replace(path, r"[?#].*$", ""), r"/+$", "")


def suffix(path: Column) -> Column:
    """Lower-cased extension with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(F.element_at(F.split(bare_path(path), "/"), -1), r"(\.[^.]+)$", 1))


def catalog(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``type``, ``label`` and ``filename`` from the last three path parts."""
    parts = F.split(bare_path(F.col(path)), "/")
    return df.withColumns({
        "type": F.element_at(parts, -3), "label": F.element_at(parts, -2), "filename": F.element_at(parts, -1),
    })


def count_by_folder(df: DataFrame, allowed: list[str], path: str = "path") -> DataFrame:
    """Number of files per folder whose suffix is in the allow-list."""
    folder = F.regexp_replace(bare_path(F.col(path)), r"/[^/]*$", "")
    return df.filter(suffix(F.col(path)).isin(allowed)).groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n"))


def labelled_union(good: DataFrame, defect: DataFrame) -> DataFrame:
    """Good rows with label 0 and defect rows with label 1 in one frame."""
    return good.withColumn("label", F.lit(0)).unionByName(defect.withColumn("label", F.lit(1)))
