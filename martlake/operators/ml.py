"""Linear regression of the advanced analysis.

:func:`regression_folds` evaluates on k folds from one read of the rows: sums
of products of each fold, whose differences are the training sums.

MLlib's ``LinearRegression`` (normal-equation solver for few features) fits
with one distributed aggregation of XᵀX, so it scales with the rows. The
train/test split goes by the row's keys, so it is the same on every run, and
SQL can repeat it. The input frame is written once; the fit, its summary and
the evaluation read that.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.labels import flag01
from martlake.functions.numeric import money_product, money_sum
from martlake.session import written


def ml_frame(joined: DataFrame, label="price", quantity="quantity", age="age",
             segment="segment", premium_segment="BUILDING", keys=("order_id", "product_id")) -> DataFrame:
    """L1: cast, binary flag, drop rows with any NULL."""
    return joined.select(
        *[F.col(k) for k in keys],
        F.col(label).cast("double").alias("label"),
        F.col(quantity).cast("int").alias("quantity"),
        F.col(age).cast("int").alias("age"),
        flag01(F.col(segment) == F.lit(premium_segment)).alias("premium_flag")).na.drop()


def key_split(df: DataFrame, keys, train_tenths: int = 8):
    """L2: train/test split by the last digit of the keys' sum."""
    digit = F.pmod(reduce(lambda a, b: a + b, [F.col(k) for k in keys]), F.lit(10))
    return df.where(digit < train_tenths), df.where(digit >= train_tenths)


def fit_regression(train: DataFrame, features=("quantity", "age", "premium_flag")):
    """Assembler + linear regression as one Pipeline."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol="label")
    return Pipeline(stages=[assembler, lr]).fit(train)


def regression_metrics(joined: DataFrame, digits: int = 6, **kw) -> DataFrame:
    """One row with the coefficient of each feature, the intercept,
    R² (train) and RMSE (test), rounded to ``digits``: the last bits depend on
    the order in which sums are taken."""
    data = written(ml_frame(joined, **kw), "regression")
    train, test = key_split(data, kw.get("keys", ("order_id", "product_id")))
    model = fit_regression(train)
    lr_model = model.stages[-1]
    rmse = RegressionEvaluator(labelCol="label", predictionCol="prediction",
                               metricName="rmse").evaluate(model.transform(test))
    values = {f"coef_{n}": x for n, x in zip(("quantity", "age", "premium_flag"), lr_model.coefficients)}
    values |= {"intercept": lr_model.intercept, "r2": lr_model.summary.r2, "rmse": rmse}
    return joined.sparkSession.createDataFrame(
        [tuple(round(float(x), digits) for x in values.values())],
        ", ".join(f"{n} double" for n in values))


# ---- k folds from one read (L2, L4-L6) ---------------------------------------

FEATURES = ("quantity", "age", "premium_flag")


def fold_of(keys, folds: int):
    """L2: fold 0 to ``folds`` - 1 of a row, by the sum of its keys."""
    return F.pmod(reduce(lambda a, b: a + b, [F.pmod(F.col(k), F.lit(folds)) for k in keys]), F.lit(folds))


def fold_sums(data: DataFrame, keys, folds: int, features=FEATURES) -> DataFrame:
    """One row for each fold that has rows: their number, and the sums of the
    columns and of their products. The sums are exact for values of six
    decimals, so training sums are a difference without a loss."""
    names = [*features, "label"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return data.groupBy(fold_of(keys, folds).cast("int").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), *[money_sum(a).alias(f"s_{i}") for i, a in enumerate(names)],
        *[F.sum(money_product(a, b)).alias(f"s_{names.index(a)}_{names.index(b)}") for a, b in pairs])


def _moments(row, width: int) -> list[list[Fraction]]:
    """The symmetric matrix of sums of products of (1, features, label)."""
    m = [[Fraction(0)] * (width + 1) for _ in range(width + 1)]
    m[0][0] = Fraction(row["n"])
    for i in range(width):
        m[0][i + 1] = m[i + 1][0] = Fraction(row[f"s_{i}"])
        for j in range(i, width):
            m[i + 1][j + 1] = m[j + 1][i + 1] = Fraction(row[f"s_{i}_{j}"])
    return m


def _solve(a: list[list[Fraction]], y: list[Fraction]) -> list[Fraction] | None:
    """Solution of a small linear system in fractions; None if it is singular."""
    rows = [[*r, v] for r, v in zip(a, y)]
    for c in range(len(rows)):
        pivot = next((r for r in range(c, len(rows)) if rows[r][c]), None)
        if pivot is None:
            return None
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(len(rows)):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * p for x, p in zip(rows[r], rows[c])]
    return [r[-1] for r in rows]


def _squared_error(m: list[list[Fraction]], beta: list[Fraction]) -> Fraction:
    """Sum of squared residuals of the rows whose sums of products are ``m``."""
    w = [*beta, Fraction(-1)]
    return sum((w[i] * w[j] * m[i][j] for i in range(len(w)) for j in range(len(w))), Fraction(0))


def regression_folds(joined: DataFrame, folds: int = 5, digits: int = 6, features=FEATURES, **kw) -> DataFrame:
    """L2, L4-L6 by k folds: for each fold the regression on all other folds,
    R² there and RMSE on the fold, rounded to ``digits``. Every fold has a row.

    The rows are read once and combined map-side into one row for each fold;
    ``folds`` such rows come to the driver, whatever the input. Coefficients
    and errors are NULL where the training columns are dependent or there is
    no training row, R² where the training label is constant, RMSE where the fold
    is empty.
    """
    data = ml_frame(joined, **kw)
    width = len(features) + 1
    found = {r["fold"]: _moments(r, width)
             for r in fold_sums(data, kw.get("keys", ("order_id", "product_id")), folds, features).collect()}
    zero = [[Fraction(0)] * (width + 1) for _ in range(width + 1)]
    total = [[sum((m[i][j] for m in found.values()), Fraction(0)) for j in range(width + 1)] for i in range(width + 1)]
    out = []
    for fold in range(folds):
        test = found.get(fold, zero)
        train = [[t - x for t, x in zip(*pair)] for pair in zip(total, test)]
        n_train, n_test = train[0][0], test[0][0]
        beta = _solve([r[:width] for r in train[:width]], [r[width] for r in train[:width]])
        values = [None] * (width + 2)
        if beta is not None:
            spread = train[width][width] - train[0][width] ** 2 / n_train
            r2 = float(1 - _squared_error(train, beta) / spread) if spread else None
            rmse = math.sqrt(_squared_error(test, beta) / n_test) if n_test else None
            values = [None if x is None else round(float(x), digits) + 0.0 for x in [*beta[1:], beta[0], r2, rmse]]
        out.append((fold, int(n_train), int(n_test), *values))
    return joined.sparkSession.createDataFrame(
        out, "fold int, n_train bigint, n_test bigint, " + ", ".join(
            f"`{n}` double" for n in [*[f"coef_{f}" for f in features], "intercept", "r2", "rmse"]))
