import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.operators import quantile
from salesloom.operators.quantile import exact_quantile, exact_quantiles

CASES = {
    "one": [5.0],
    "two": [1.0, 2.0],
    "ties": [1.0] * 50 + [2.0] * 50,
    "small": [float(x) for x in range(21)],
    "hot value": [7.0] * 400 + [float(x) for x in range(800)],
    "random": [random.Random(4).uniform(-1e6, 1e6) for _ in range(5000)],
}


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("name", CASES)
def test_equals_the_sorted_answer(spark, name, q):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(5)
    got = exact_quantile(df, "x", q).first()[0]
    assert got == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("q", [0.5, 0.95, 0.999])
def test_exact_although_the_sketch_is_coarse(spark, q):
    values = [round(random.Random(9).gauss(0, 1) * (i % 97), 3) for i in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    assert exact_quantile(df, "x", q, accuracy=50).first()[0] == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


@pytest.mark.parametrize("accuracy", [50, 100_000])
@pytest.mark.parametrize("name", CASES)
def test_several_levels_in_one_call(spark, name, accuracy):
    levels = [0.9, 0.0, 0.5, 0.52, 1.0]
    df = spark.createDataFrame([(v,) for v in CASES[name]], "x double").repartition(5)
    got = {r.level: r.quantile for r in exact_quantiles(df, "x", levels, accuracy).collect()}
    assert got == {q: pytest.approx(float(np.quantile(CASES[name], q)), rel=1e-12, abs=1e-12) for q in levels}


def test_no_values(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5).first()[0] is None


@pytest.mark.parametrize("at_once", [1, 30])
@pytest.mark.parametrize("name", CASES)
def test_few_values_at_once(spark, name, at_once):
    """Parts are cut again and again, whatever the sketch is worth."""
    df = spark.createDataFrame([(v,) for v in CASES[name]], "x double").repartition(5)
    got = [r.quantile for r in exact_quantiles(df, "x", [0.0, 0.33, 0.95, 1.0], 20, at_once).collect()]
    assert got == pytest.approx([float(np.quantile(CASES[name], q)) for q in (0.0, 0.33, 0.95, 1.0)], rel=1e-12, abs=1e-12)


def looked_at(monkeypatch):
    """The sizes of what the quantile collected in one task, in rounds."""
    sizes = []
    look = quantile._look

    def noted(zone, cut, ranks, collect):
        sizes.append(zone.size if cut is None else 10 * zone.size / 1000 if collect else 0)
        return look(zone, cut, ranks, collect)

    monkeypatch.setattr(quantile, "_look", noted)
    return sizes


@pytest.mark.parametrize("shape", ["id", "IF(id = 77, 1e18D, id)", "IF(id % 3 = 0, 190000, id)", "IF(id % 3 = 0, -1e18D, 1 / (id + 1))"])
def test_outliers_and_hot_values_leave_no_large_part(spark, monkeypatch, shape):
    """One value beyond all others, or a third of the rows with one value: no task collects more than asked for."""
    sizes = looked_at(monkeypatch)
    df = spark.range(200_000).selectExpr(f"CAST({shape} AS DOUBLE) AS x")
    values = df.toPandas()["x"].to_numpy()
    levels = (0.3333, 0.5, 0.95, 0.999)
    got = [r.quantile for r in exact_quantiles(df, "x", levels, 1000, 500).collect()]
    assert got == pytest.approx([float(np.quantile(values, q)) for q in levels], rel=1e-12)
    assert sizes and max(sizes) <= 500


def test_a_sketch_that_misses_costs_rounds_only(spark):
    """Cuts at the wrong end of the values: the part that holds the rank is the rest, and is cut again."""
    values = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    whole = quantile.Zone(None, None, 0, 1000)
    got = quantile._values_at(values, {500: whole, 3: whole}, {500: (1.0, 2.0), 3: (900.0, 950.0)}, 1000, 20)
    assert got == {500: 500.0, 3: 3.0}


def test_decimals_and_infinity(spark):
    df = spark.sql("SELECT CAST(id AS DECIMAL(24,4)) / 8 AS x FROM range(1000)")
    assert exact_quantile(df, "x", 0.95, 100, 10).first()[0] == pytest.approx(float(np.quantile(np.arange(1000) / 8, 0.95)))
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("inf"),)], "x double")
    assert exact_quantile(df, "x", 0.9).first()[0] == float("inf")
