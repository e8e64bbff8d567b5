"""Feature preparation: scaling, encoding, expansion, binning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrail.operators.grouped import join_small, ranked
from sentrail.operators.quantiles import exact_quantiles
from sentrail.session import materialise, row_count


def indexers(cat_cols: Sequence[str], handle_invalid: str = "keep") -> list[StringIndexer]:
    """Frequency index per text column. "keep" gives unseen and null values an index of their
    own, so that no row loses its score; "skip" drops such rows."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid=handle_invalid) for c in cat_cols]


def category_ranks(df: DataFrame, column: str) -> DataFrame:
    """(column, index) of every category: 0 for the most frequent, equally frequent ones by name. A written table, ranked
    by ranges: a category per row needs neither a list on the driver nor a task that sees them all."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("_n").desc(), F.col(column).asc()]
    return materialise(ranked(counts, [], order, f"{column}_index").select(column, F.col(f"{column}_index").cast("double")), "category-ranks")


def index_categories(df: DataFrame, ranks: DataFrame, column: str, handle_invalid: str = "keep") -> DataFrame:
    """Adds the frequency index of ``column``. Unseen and null values get the index after the last ("keep") or lose their row ("skip")."""
    joined = join_small(df, ranks, [column], "left" if handle_invalid == "keep" else "inner", row_bytes=64)
    return joined.withColumn(f"{column}_index", F.coalesce(f"{column}_index", F.lit(float(row_count(ranks)))))


def encoders(cat_cols: Sequence[str]) -> list[OneHotEncoder]:
    """One-hot vectors of the indexes without the last slot. Behind indexers that keep invalid values
    that slot is theirs, so each category has one and unknown values are all zeros; behind others
    (handle_invalid "error" or "skip") the rarest category is left out."""
    return [OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_vec", dropLast=True) for c in cat_cols]


def scaling_stages(num_cols: Sequence[str]) -> list:
    """Centre and scale by the sample deviation; a constant column becomes 0. Missing numbers lie
    at the column's mean; a column of nothing else can't be fitted."""
    if not num_cols:
        return []
    # as doubles first: an imputer writes the mean in the column's own type
    doubles = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `_num{i}`" for i, c in enumerate(num_cols))
    filled = [f"_filled{i}" for i in range(len(num_cols))]
    return [
        SQLTransformer(statement=f"SELECT *, {doubles} FROM __THIS__"),
        Imputer(strategy="mean", inputCols=[f"_num{i}" for i in range(len(num_cols))], outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="features_vec", handleInvalid="error"),
        StandardScaler(inputCol="features_vec", outputCol="features_zs", withMean=True, withStd=True),
    ]


def feature_pipeline(
    num_cols: Sequence[str], cat_cols: Sequence[str], one_hot: bool = False, handle_invalid: str = "keep"
) -> Pipeline:
    """Categories first (index or one-hot), scaled numbers after, assembled as ``features``.
    One-hot vectors keep every category only where ``handle_invalid`` is "keep" (see ``encoders``)."""
    encoded = [f"{c}_vec" if one_hot else f"{c}_index" for c in cat_cols]
    stages = [*indexers(cat_cols, handle_invalid)]
    if one_hot:
        stages += encoders(cat_cols)
    stages += scaling_stages(num_cols)
    inputs = encoded + (["features_zs"] if num_cols else [])
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column: two numbers each, kept on the driver."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standardise(column: Column, mean: float, sd: float) -> Column:
    """(x - mean) / sd; a zero deviation divides by one."""
    return (column - F.lit(float(mean))) / F.lit(float(sd) if sd else 1.0)


def interactions(columns: Sequence[str]) -> dict[str, Column]:
    """Products of every pair of distinct columns, no squares."""
    return {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(columns, 2)}


def fit_quantile_edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Inner bin edges per column at equal quantiles; repeated edges collapse."""
    probabilities = [i / bins for i in range(1, bins)]
    edges = {}
    for column in columns:
        found = exact_quantiles(df, column, probabilities).first()
        edges[column] = sorted(set(found["quantiles"])) if found else []
    return edges


def quantile_bin(column: Column, edges: Sequence[float]) -> Column:
    """Ordinal bin: how many inner edges the value reaches; null stays null."""
    index = F.lit(0)
    for edge in edges:
        index = index + F.when(column >= F.lit(float(edge)), 1).otherwise(0)
    return F.when(column.isNotNull(), index)


def quantile_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "_bin") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": quantile_bin(F.col(c), e) for c, e in edges.items()})
