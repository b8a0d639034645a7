"""One-hot columns from stored levels, and alignment to a stored column list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of one column that may become columns of a table.
MOST_LEVELS = 1_000


class TooManyLevels(ValueError):
    """A column has more levels than a table should have columns."""


def level_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Number of different non-null levels per column; nothing but the numbers leaves the executors."""
    pairs = _levels(df, cols).groupBy("name").count().collect()
    return {c: 0 for c in cols} | {row.name: row["count"] for row in pairs}


def _levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = [
        df.select(F.lit(c).alias("name"), F.col(c).cast("string").alias("level"))
        .where(F.col("level").isNotNull())
        .distinct()
        for c in cols
    ]
    return reduce(DataFrame.unionByName, pairs)


def fit_levels(df: DataFrame, cols: Sequence[str], most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Distinct non-null levels per column, sorted by code point.

    The levels become columns of the encoded table, so they come to the driver: at
    most ``most`` of a column, and one more by which an error tells that there are too
    many.  ``sparse_one_hot`` takes columns of any number of levels.
    """
    limited = [_levels(df, [c]).limit(most + 1) for c in cols]
    rows = reduce(DataFrame.unionByName, limited).collect()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for row in rows:
        levels[row.name].append(row.level)
    crowded = [c for c, found in levels.items() if len(found) > most]
    if crowded:
        raise TooManyLevels(f"more than {most} levels in {', '.join(crowded)}; use sparse_one_hot for these columns")
    for found in levels.values():
        found.sort()
    return levels


def sparse_one_hot(cols: Sequence[str], to: str = "categories") -> Pipeline:
    """All columns as one sparse vector: levels by code point, then one place for null and unseen ones.

    For columns whose levels are too many to be columns themselves.
    """
    codes, parts = [f"_code_{c}" for c in cols], [f"_part_{c}" for c in cols]
    indexer = StringIndexer(
        inputCols=list(cols), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    encoder = OneHotEncoder(inputCols=codes, outputCols=parts, dropLast=False)
    return Pipeline(stages=[indexer, encoder, VectorAssembler(inputCols=parts, outputCol=to)])


def ones(vector: str) -> tuple[Column, Column]:
    """Width of a vector column and the places that hold 1, ascending.

    A sparse vector is read as it is stored, so a row costs its non-zero places and not the width.
    """
    stored = F.unwrap_udt(F.col(vector))
    sparse, values = stored["type"] == 0, stored["values"]
    places = F.when(sparse, stored["indices"]).otherwise(F.transform(values, lambda _, place: place))
    return F.when(sparse, stored["size"]).otherwise(F.size(values)), F.filter(places, lambda _, k: F.get(values, k) == 1)


def encoded_names(
    levels: dict[str, list[str]], drop_first: bool = True, null_column: bool = True
) -> list[str]:
    names = []
    for c, found in levels.items():
        names += [f"{c}_{level}" for level in found[1 if drop_first else 0 :]]
        if null_column:
            names.append(f"{c}_nan")
    return names


def one_hot(
    df: DataFrame,
    levels: dict[str, list[str]],
    drop_first: bool = True,
    null_column: bool = True,
) -> DataFrame:
    """Replace each column by boolean columns, one per stored level.

    The smallest level is dropped, and ``<col>_nan`` marks null.  A level that was
    not stored gives all false; ``unseen_levels`` counts those.
    """
    encoded = [F.col(f"`{c}`") for c in df.columns if c not in levels]
    for c, found in levels.items():
        for level in found[1 if drop_first else 0 :]:
            encoded.append(F.coalesce(F.col(c) == F.lit(level), F.lit(False)).alias(f"{c}_{level}"))
        if null_column:
            encoded.append(F.col(c).isNull().alias(f"{c}_nan"))
    return df.select(*encoded)


def unseen_levels(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Rows per column whose level is not among the stored ones."""
    counts = [
        F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(found)).alias(c)
        for c, found in levels.items()
    ]
    return df.agg(*counts).unpivot([], list(levels), "column", "unseen_rows")


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The stored feature list as doubles, 0 for what is missing or null."""
    present = set(df.columns)
    aligned = [
        (
            F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))
            if name in present
            else F.lit(0.0)
        ).alias(name)
        for name in features
    ]
    return df.select(*keep, *aligned)


def alignment_report(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()
) -> dict[str, list[str]]:
    """Feature names the table lacks, and columns no feature takes."""
    given = [c for c in df.columns if c not in keep]
    return {
        "missing": [name for name in features if name not in given],
        "ignored": [c for c in given if c not in features],
    }


def alignment_table(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(column, status, rows): ``missing`` features filled with 0 and how many rows that meets,
    ``ignored`` columns and the rows that have a value other than null, false or 0 there."""
    report = alignment_report(df, features, keep)
    told = [F.count("*").alias(f"missing|{c}") for c in report["missing"]]
    for c in report["ignored"]:
        value = F.col(f"`{c}`").cast("string")
        told.append(F.count_if(~value.isin("false", "0", "0.0")).alias(f"ignored|{c}"))
    schema = "column STRING, status STRING, rows BIGINT"
    if not told:
        return df.sparkSession.createDataFrame([], schema)
    long = df.agg(*told).unpivot([], [F.col(f"`{c}`") for c in (f"{s}|{n}" for s in report for n in report[s])], "name", "rows")
    return long.select(
        F.split_part("name", F.lit("|"), F.lit(2)).alias("column"),
        F.split_part("name", F.lit("|"), F.lit(1)).alias("status"),
        "rows",
    )
