"""Data quality: rule reports, levels, dead-letter routing, PII hashing
(Q1-Q10, U3, P19).

A report is a small DataFrame ``(rule, failures)`` computed by ONE
aggregate over the data (``count_if`` per rule, combined map-side), then
unpivoted. Only the report — one row per rule — is ever brought to the
driver, and only by :func:`enforce`.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martlake.functions.predicates import definitely, not_in, null_or_empty, shorter_or_null

log = logging.getLogger(__name__)

# The strict level's price bounds and minimum name length.
STRICT_MAX_PRICE = 10000
STRICT_MIN_NAME_LENGTH = 3


def rule_report(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(rule, failures) for each ``(name, failing_condition)``; a NULL
    condition does not count as a failure."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, failures bigint")
    counts = df.agg(*[F.count_if(definitely(cond)).alias(f"_r{i}")
                      for i, (_, cond) in enumerate(rules)])
    # one row -> one row per rule (names are literals, never SQL text)
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("failures"))
                      for i, (name, _) in enumerate(rules)])
    return counts.select(F.inline(pairs))


def basic_rules(price="price", category="category") -> list[tuple[str, Column]]:
    """Q1: negative prices; NULL or empty categories."""
    return [("negative_price", F.col(price) < 0),
            ("empty_category", null_or_empty(category))]


def strict_rules(allowed_categories, price="price", name="product_name",
                 category="category") -> list[tuple[str, Column]]:
    """Q2: price <= 0 or > 10000; name NULL or shorter than 3; category
    outside the allowed list (NULL counts as outside)."""
    return [("suspicious_price", (F.col(price) <= 0) | (F.col(price) > STRICT_MAX_PRICE)),
            ("short_or_missing_name", shorter_or_null(name, STRICT_MIN_NAME_LENGTH)),
            ("invalid_category", not_in(category, allowed_categories))]


def validate(df: DataFrame, level: str = "basic", allowed_categories=(), **cols) -> DataFrame:
    """Q3: level switch none / basic / strict -> report frame."""
    if level == "none":
        return rule_report(df, [])
    if level == "basic":
        return rule_report(df, basic_rules(**{k: v for k, v in cols.items()
                                              if k in ("price", "category")}))
    if level == "strict":
        return rule_report(df, strict_rules(allowed_categories, **cols))
    raise ValueError(f"unknown validation level {level!r}")


def enforce(report: DataFrame, level: str = "strict") -> list[str]:
    """Collect the (rule-sized) report; strict raises on any failure, basic
    only returns the messages."""
    msgs = [f"{r.rule}: {r.failures} rows" for r in report.collect() if r.failures]
    if msgs and level == "strict":
        raise ValueError(f"strict validation failed with {len(msgs)} errors: {msgs}")
    for m in msgs:
        log.warning("validation: %s", m)
    return msgs


def required_columns_missing(df: DataFrame, required) -> list[str]:
    """Required columns absent from the schema (no job runs)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def validate_df(df: DataFrame, min_rows: int = 1, key_columns=()) -> DataFrame:
    """Q4: one-row check: row count against a minimum and NULLs in key
    columns."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in key_columns]
    st = df.agg(*aggs)
    ok = F.col("row_count") >= F.lit(min_rows)
    for c in key_columns:
        ok = ok & (F.col(f"null_{c}") == 0)
    return st.withColumn("passed", ok)


def record_is_valid(id_col="id", value_col="value") -> Column:
    """``id > 0 AND value IS NOT NULL``; anything NULL -> False."""
    return definitely((F.col(id_col) > 0) & F.col(value_col).isNotNull())


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) complement; a NULL predicate counts as invalid."""
    flag = definitely(valid)
    return df.where(flag), df.where(~flag)


def dead_letter(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Q6: rows failing any rule with the names of the failed rules."""
    reasons = F.array_compact(F.array(*[F.when(definitely(c), F.lit(n)) for n, c in rules]))
    return (df.withColumn("failed_rules", reasons)
            .where(F.size("failed_rules") > 0)
            .withColumn("failed_rules", F.concat_ws(",", "failed_rules")))


def route_dead_letter(df: DataFrame, rules, error_path: str, batch: str = "0",
                      fmt: str = "parquet") -> DataFrame:
    """Write the failing rows to the error area, one folder for each
    batch key (a rerun of a batch rewrites its own rows, others stay); return
    the valid rows."""
    bad = dead_letter(df, rules)
    bad.write.mode("overwrite").format(fmt).save(f"{error_path.rstrip('/')}/batch={batch}")
    ok = reduce(lambda a, b: a & b, [~definitely(c) for _, c in rules], F.lit(True))
    return df.where(ok)


# ---- rules driven by configuration (Q7) ------------------------------------

def rule_from_config(rule: dict) -> tuple[str, Column]:
    """A rules-file entry -> (name, failing condition).

    Supported checks: not_null, min, max, in_set, min_length, max_length,
    regex, unique is not row-local and therefore not offered here.
    """
    c, check = rule["column"], rule["check"]
    x = F.col(c)
    if check == "not_null":
        cond = x.isNull()
    elif check == "min":
        cond = x < F.lit(rule["value"])
    elif check == "max":
        cond = x > F.lit(rule["value"])
    elif check == "in_set":
        cond = not_in(c, rule["values"])
    elif check == "min_length":
        cond = shorter_or_null(c, int(rule["value"]))
    elif check == "max_length":
        cond = F.length(x) > F.lit(int(rule["value"]))
    elif check == "regex":
        cond = ~F.coalesce(x.rlike(rule["pattern"]), F.lit(False))
    else:
        raise ValueError(f"unknown check {check!r}")
    return rule.get("name", f"{c}_{check}"), cond


def config_report(df: DataFrame, rules_config: list[dict]) -> DataFrame:
    return rule_report(df, [rule_from_config(r) for r in rules_config])


# ---- PII and audit ------------------------------------------------------------

def anonymize_pii(df: DataFrame, email="email", name_columns=("first_name", "last_name")) -> DataFrame:
    """Q9: ``hashed_email = sha2(email)``, ``hashed_name = sha2(names, one
    directly behind the other)``; the originals are dropped."""
    names = list(name_columns)
    return (df.withColumn("hashed_email", F.sha2(F.col(email), 256))
            .withColumn("hashed_name", F.sha2(F.concat_ws("", *[F.col(c) for c in names]), 256))
            .drop(email, *names))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Q10: attach a row counter that is filled by the job that consumes the
    frame (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
