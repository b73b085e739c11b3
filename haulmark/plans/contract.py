"""Pre-load contract of raw records: required keys, text widths, numeric ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.metrics import n_where
from haulmark.schemas import MAX_TEXT, RAW_SCHEMA, REQUIRED_RAW


class ContractError(ValueError):
    """Raw records that the warehouse tables cannot hold."""


def _rules(name: str) -> dict[str, Column]:
    """The rules of one raw column: what is wrong -> condition under which it is."""
    rules = {}
    if name in REQUIRED_RAW:
        rules[f"{name} is null"] = F.col(name).isNull()
    if name in MAX_TEXT:
        width = MAX_TEXT[name]
        rules[f"{name} longer than {width}"] = F.length(name) > width
    return rules


def _all_rules() -> dict[str, Column]:
    return {rule: broken for name in RAW_SCHEMA for rule, broken in _rules(name).items()}


def reject_reasons(raw: DataFrame) -> DataFrame:
    """Violating records, each with the list of the rules it breaks."""
    reasons = [F.when(broken, F.lit(rule)) for rule, broken in _all_rules().items()]
    listed = raw.withColumn("reasons", F.array_compact(F.array(*reasons)))
    return listed.filter(F.size("reasons") > 0)


def violations(raw: DataFrame) -> dict[str, int]:
    """Broken rules and how many records break each, from a single pass."""
    counted = [n_where(broken).alias(rule) for rule, broken in _all_rules().items()]
    return {rule: n for rule, n in raw.agg(*counted).first().asDict().items() if n}


def enforced(raw: DataFrame) -> DataFrame:
    """The same records, with the rules built into the columns they concern.

    A job that uses a column stops at the first record that breaks one of its rules, so
    the contract costs no pass of its own.
    """
    checked = {}
    for name in RAW_SCHEMA:
        value = F.col(name)
        for rule, broken in _rules(name).items():
            value = F.when(broken, F.raise_error(F.lit(f"contract: {rule}"))).otherwise(value)
        checked[name] = value
    return raw.withColumns(checked)


def require_contract(raw: DataFrame, failure: Exception) -> None:
    """After a failed job: if a rule was broken, raise a full account of all broken rules."""
    if "contract: " in str(failure):
        raise ContractError(f"raw records rejected: {violations(raw)}") from failure


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns in table order and type; a number that does not fit fails the job."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])
