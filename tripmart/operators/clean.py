"""Cleaning: required columns, range rules and the fee/ordering predicate.

All operators are lazy `DataFrame -> DataFrame` filters.  Predicates are
built as Column conjunctions so that Catalyst can push the simple ones
(IS NOT NULL, NOT isnan, comparisons with literals) into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import (DEFAULT_WINDOW, DROPOFF_COLUMN, FEE_BYPASS_VALUE,
                      FEE_CLEAN_VALUE, FEE_COLUMN, PICKUP_COLUMN, RANGE_RULES,
                      REQUIRED_COLUMNS)

_FLOATING = (T.DoubleType, T.FloatType)


def _and_all(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def _bound(value):
    """Rule bounds become typed literals: str -> TIMESTAMP_NTZ (a date string
    compares as its midnight), numbers -> double."""
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(float(value))


def not_null_predicate(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    """Row has no NULL, and no NaN in floating columns (what `na.drop` drops)."""
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    preds = []
    for c in columns:
        preds.append(F.col(c).isNotNull())
        if isinstance(types.get(c.lower()), _FLOATING):
            preds.append(~F.isnan(F.col(c)))
    return _and_all(preds)


def required_not_null(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    return df.where(not_null_predicate(df, columns))


def rules_with_window(window=DEFAULT_WINDOW, rules=RANGE_RULES):
    """Full rule table: the numeric rules plus the date window rules."""
    start, end = window
    return list(rules) + [(PICKUP_COLUMN, start, None), (DROPOFF_COLUMN, None, end)]


def range_predicate(rules) -> Column:
    """Conjunction of inclusive bounds; `None` means no bound."""
    preds = []
    for col, lo, hi in rules:
        if lo is not None:
            preds.append(F.col(col) >= _bound(lo))
        if hi is not None:
            preds.append(F.col(col) <= _bound(hi))
    return _and_all(preds)


def range_rules(df: DataFrame, window=DEFAULT_WINDOW, rules=RANGE_RULES) -> DataFrame:
    return df.where(range_predicate(rules_with_window(window, rules)))


def clean_predicate(window=DEFAULT_WINDOW, mode: str = "as_written",
                    rules=RANGE_RULES, fee_column: str = FEE_COLUMN) -> Column:
    """Fee domain + pickup-before-dropoff + range rules.

    mode="as_written": `fee = 1.25 OR (fee = 0 AND order AND ranges)` —
        the source's operator precedence: a 1.25 fee bypasses every rule.
    mode="grouped": `(fee = 1.25 OR fee = 0) AND order AND ranges`.
    """
    fee = F.col(fee_column)
    bypass = fee == F.lit(FEE_BYPASS_VALUE)
    clean_fee = fee == F.lit(FEE_CLEAN_VALUE)
    rest = (F.col(PICKUP_COLUMN) < F.col(DROPOFF_COLUMN)) & range_predicate(
        rules_with_window(window, rules))
    if mode == "as_written":
        return bypass | (clean_fee & rest)
    if mode == "grouped":
        return (bypass | clean_fee) & rest
    raise ValueError(f"unknown clean mode {mode!r}")


def clean(df: DataFrame, window=DEFAULT_WINDOW, mode: str = "as_written",
          required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Required-column drop followed by the fee/ordering/range filter."""
    fee_col = _resolve(df, FEE_COLUMN)
    # Both modes imply the fee domain.  Said on its own it reaches the scan,
    # which the as-written OR as a whole cannot.
    domain = F.col(fee_col).isin(FEE_BYPASS_VALUE, FEE_CLEAN_VALUE)
    return df.where(not_null_predicate(df, required) & domain
                    & clean_predicate(window, mode, fee_column=fee_col))


def _resolve(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    return name


def rule_checks(df: DataFrame, window=DEFAULT_WINDOW, rules=RANGE_RULES):
    """(rule name, predicate) pairs, one per rule, for auditing."""
    fee = F.col(_resolve(df, FEE_COLUMN))
    checks = [
        ("required_not_null", not_null_predicate(df)),
        ("fee_domain", (fee == F.lit(FEE_BYPASS_VALUE)) | (fee == F.lit(FEE_CLEAN_VALUE))),
        ("pickup_before_dropoff", F.col(PICKUP_COLUMN) < F.col(DROPOFF_COLUMN)),
    ]
    for col, lo, hi in rules_with_window(window, rules):
        checks.append((f"range_{col}", range_predicate([(col, lo, hi)])))
    checks.append(("kept_as_written", not_null_predicate(df) & clean_predicate(window, "as_written")))
    checks.append(("kept_grouped", not_null_predicate(df) & clean_predicate(window, "grouped")))
    return checks


def rule_violations(df: DataFrame, window=DEFAULT_WINDOW, rules=RANGE_RULES) -> DataFrame:
    """Rows failing each rule (NULL counts as failing), in ONE aggregate pass.

    Output: (rule, failing, passing) — one row per rule.  The two `kept_*`
    rows count what each clean mode keeps (failing = dropped).
    """
    checks = rule_checks(df, window, rules)
    aggs = []
    for i, (_, pred) in enumerate(checks):
        aggs.append(F.count_if(~F.coalesce(pred, F.lit(False))).alias(f"f{i}"))
        aggs.append(F.count_if(F.coalesce(pred, F.lit(False))).alias(f"p{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{name}', f{i}, p{i}" for i, (name, _) in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) AS (rule, failing, passing)")
