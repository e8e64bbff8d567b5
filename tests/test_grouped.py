"""Keyed building blocks, with one group holding most of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrail.operators.grouped import dense_index, join_small, salted_join
from sentrail.operators.quantiles import exact_quantiles
from sentrail.session import materialise, row_count, shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    # group 0 holds two thirds of 9,000 rows
    rows = spark.range(9_000).select(
        F.col("id"), F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7 + 1).alias("g"), (F.col("id") * 37 % 1009).alias("x")
    )
    return materialise(rows, "skewed")


def sizes_of(df):
    return df.groupBy("g").agg(F.count(F.lit(1)).alias("_n"))


def test_dense_index_numbers_each_group_without_gaps(skewed):
    numbered = dense_index(skewed, sizes_of(skewed), ["g"], ["id"], bucket_rows=500)
    found = numbered.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("_idx").alias("k"), F.min("_idx").alias("lo"), F.max("_idx").alias("hi")
    )
    assert all(r.k == r.n and r.lo == 0 and r.hi == r.n - 1 for r in found.collect())
    assert numbered.count() == skewed.count()


def test_dense_index_does_not_depend_on_partitions(skewed):
    one = dense_index(skewed.coalesce(1), sizes_of(skewed), ["g"], ["id"], bucket_rows=500)
    many = dense_index(skewed.repartition(13), sizes_of(skewed), ["g"], ["id"], bucket_rows=500)
    assert one.select("id", "_idx").exceptAll(many.select("id", "_idx")).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_plain_join(skewed, how):
    small = sizes_of(skewed).where("g <> 3")
    plain = skewed.join(small, ["g"], how).select("id", "g", "x", "_n")
    assert salted_join(skewed, small, ["g"], how).select(plain.columns).exceptAll(plain).isEmpty()
    assert salted_join(skewed, small, ["g"], how).count() == plain.count()


def test_join_small_leaves_the_broadcast_when_the_table_is_large(skewed):
    small = sizes_of(skewed)
    broadcast = join_small(skewed, small, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    salted = join_small(skewed, small, ["g"], max_bytes=256, row_bytes=256)
    assert "broadcast" in broadcast and "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert salted.count() == skewed.count()


def test_exact_quantiles_match_numpy(skewed):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {r.g: r.quantiles for r in exact_quantiles(skewed, "x", probabilities, ["g"]).collect()}
    local = skewed.toPandas()
    for g, part in local.groupby("g"):
        np.testing.assert_allclose(found[g], np.quantile(part["x"], probabilities))


def test_exact_quantiles_of_one_value_and_of_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, None), (2, 1.0)], "g int, x double")
    found = {r.g: r.quantiles for r in exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert found == {1: [5.0], 2: [1.0]}


def test_materialise_uses_the_configured_folder(spark, skewed):
    assert row_count(skewed) == 9_000
    assert skewed.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(shared_dir(spark).split(":", 1)[-1].lstrip("/"))
