"""Findings, flags, scores: how every check reports.

A check is a column expression giving a flag. All checks of a row sit in one array column, so a
stage is a single projection: no rows are added or dropped and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsguard.catalogs import rulebook as R
from obsguard.functions import scalars as S

FAILED = ("SUSPECT", "ERROR", "MISSING")
RESULT_TYPE = (
    "array<struct<rule_id:string,variable:string,flag:string,severity:string,"
    "observed_value:string,expected_value:string,message:string>>"
)


def flag_when(bad: Column, flag: str, needs: Iterable[Column] = (), skip: Column | None = None) -> Column:
    """NOT_CHECKED where an input is missing (or ``skip``), the flag where ``bad``, else PASS."""
    absent = [c.isNull() for c in needs]
    if skip is not None:
        absent.append(skip)
    out = F.when(bad, F.lit(flag)).otherwise(F.lit("PASS"))
    return F.when(S.any_of(absent), F.lit("NOT_CHECKED")).otherwise(out) if absent else out


@dataclass(frozen=True)
class Check:
    """One evaluated check: its flag expression and what to report with it."""

    rule_id: str
    flag: Column
    variable: str = ""
    observed: Column | None = None
    expected: str = ""


def lookup(mapping: dict[str, object], c: Column, default=None) -> Column:
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def result_struct(check: Check) -> Column:
    observed = check.observed if check.observed is not None else F.lit(None)
    return F.struct(
        F.lit(check.rule_id).alias("rule_id"),
        F.lit(check.variable).alias("variable"),
        check.flag.alias("flag"),
        lookup(R.FLAG_SEVERITY, check.flag).alias("severity"),
        F.when(check.flag.isin(*FAILED), observed.cast("string")).alias("observed_value"),
        F.lit(check.expected).alias("expected_value"),
        F.when(check.flag.isin(*FAILED), F.concat(F.lit(f"{check.rule_id}: "), F.lower(check.flag))).alias("message"),
    )


def evaluate(df: DataFrame, checks: list[Check], into: str = "qc_results") -> DataFrame:
    """Append the results of ``checks`` to the array column ``into``."""
    # Flags first, as columns of their own: each is used several times in its result.
    staged = df.withColumns({f"_f{i}": c.flag for i, c in enumerate(checks)})
    ready = [
        Check(c.rule_id, F.col(f"_f{i}"), c.variable, c.observed, c.expected) for i, c in enumerate(checks)
    ]
    found = F.array(*[result_struct(c) for c in ready]) if checks else F.array().cast(RESULT_TYPE)
    if into in df.columns:
        found = F.concat(F.col(into), found)
    return staged.withColumn(into, found).drop(*[f"_f{i}" for i in range(len(checks))])


# The functions below read one field of all results (``results.flag`` is an array) and use array
# built-ins without lambdas, which stay in generated code.


def count_flag(results: Column, flag: str) -> Column:
    flags = results.getField("flag")
    return F.size(flags) - F.size(F.array_remove(flags, flag))


def score(results: Column) -> Column:
    lost = F.lit(0)
    for flag, points in R.SCORE_PENALTIES.items():
        lost = lost + count_flag(results, flag) * points
    return F.greatest(F.lit(0), F.least(F.lit(R.SCORE_START), F.lit(R.SCORE_START) - lost))


def worst_flag(results: Column) -> Column:
    """ERROR > MISSING > SUSPECT > PASS > NOT_CHECKED > NOT_APPLICABLE; null without results."""
    flags = results.getField("flag")
    out = F.lit(None).cast("string")
    for flag in reversed(R.FLAG_ORDER):
        out = F.when(F.array_contains(flags, flag), flag).otherwise(out)
    return out


def assess(df: DataFrame, results: str = "qc_results") -> DataFrame:
    """Per-observation outcome from the results array; row-local."""
    found = F.col(results)
    failed = sum((count_flag(found, flag) for flag in FAILED), F.lit(0))
    # A message is set exactly on failed results and starts with the rule's identifier.
    messages = F.concat_ws("; ", found.getField("message"))
    rules = F.split(F.regexp_replace(messages, r": \w+", ""), "; ")
    return df.withColumns(
        {
            "qc_flag": worst_flag(found),
            "qc_score": score(found).cast("float"),
            "qc_rule_count": F.size(found),
            "qc_failed_rule_count": failed,
            "qc_messages": messages,
            "qc_flags": F.when(messages == "", F.array().cast("array<string>")).otherwise(
                F.sort_array(F.array_distinct(rules))
            ),
        }
    ).withColumn("qc_status", F.col("qc_flag"))


def detail(df: DataFrame, ids: list[str], results: str = "qc_results", failed_only: bool = True) -> DataFrame:
    """One row per finding; passing results are dropped as they are unpacked."""
    # The outer form: for the inner one the optimizer tests the size of the array on every row
    # first, which evaluates all checks a second time. The row of an empty array has no flag.
    rows = df.select(*ids, F.inline_outer(F.col(results)))
    return rows.filter(F.col("flag").isin(*(FAILED if failed_only else tuple(R.FLAG_CODES))))


def expression_flag(df: DataFrame, expression: str, flag: str, aliases: dict[str, str] | None = None) -> Column:
    """Flag of a check written as text: names are mapped to columns, null makes it NOT_CHECKED."""
    ok = F.expr(bind_names(expression, aliases))
    return F.when(ok.isNull(), "NOT_CHECKED").when(~ok, flag).otherwise("PASS")


def bind_names(expression: str, aliases: dict[str, str] | None = None) -> str:
    names = R.COLUMN_ALIASES if aliases is None else aliases
    return re.sub(r"[A-Za-z_][A-Za-z_0-9]*", lambda m: names.get(m.group(0), m.group(0)), expression)


def correct(
    df: DataFrame, field: str, new: Column, reason: str, at: str, into: str = "corrections"
) -> DataFrame:
    """Replace a field and record (field, old, new, reason, time) where it really changed."""
    entry = F.struct(
        F.lit(field).alias("field"),
        F.col(field).cast("string").alias("old_value"),
        F.col("_new").cast("string").alias("new_value"),
        F.lit(reason).alias("reason"),
        F.lit(at).alias("corrected_at"),
    )
    empty = F.array().cast(
        "array<struct<field:string,old_value:string,new_value:string,reason:string,corrected_at:string>>"
    )
    log = F.col(into) if into in df.columns else empty
    return (
        df.withColumn("_new", new)
        .withColumn(into, F.when(F.col("_new").eqNullSafe(F.col(field)), log).otherwise(F.concat(log, F.array(entry))))
        .withColumn(field, F.col("_new"))
        .drop("_new")
    )


# Corrections that may be applied, and actions that never are.
ALLOWED_CORRECTIONS = [
    "trim_spaces", "normalize_repeated_spaces", "normalize_case", "normalize_decimal_separator",
    "convert_units", "normalize_missing_tokens", "fix_known_header_aliases", "fix_known_typing_errors",
]
FORBIDDEN_CORRECTIONS = [
    "modify_valid_meteorological_value", "clamp_extreme_values", "invent_missing_values",
    "interpolate_missing_values", "delete_observations", "replace_suspect_values",
    "modify_original_source_file", "modify_report_text_without_traceability",
]


def audit_rules(rules: DataFrame, known_flags: list[str]) -> DataFrame:
    """Problems of a rule table (rule_id, flag, ...): repeated identifiers and unknown flags."""
    repeated = (
        rules.groupBy("rule_id").count().filter(F.col("count") > 1)
        .select("rule_id", F.lit("duplicate_rule_id").alias("problem"))
    )
    unknown = rules.filter(~F.col("flag").isin(known_flags)).select(
        "rule_id", F.lit("unknown_flag").alias("problem")
    )
    return repeated.unionByName(unknown)


def audit_references(rules: DataFrame, dimension: DataFrame, col: str, dim_key: str, problem: str) -> DataFrame:
    """Rules naming something the dimension does not have."""
    return (
        rules.filter(F.col(col).isNotNull())
        .join(dimension.select(F.col(dim_key).alias(col)).distinct(), col, "left_anti")
        .select("rule_id", F.lit(problem).alias("problem"))
    )


def audit_schema(columns: DataFrame) -> DataFrame:
    """Problems of a contract table (position, name, dtype): gaps, repeats, missing attributes."""
    size = columns.agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("lo"), F.max("position").alias("hi"),
        F.countDistinct("position").alias("d"),
    )
    gaps = size.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).select(
        F.lit("positions").alias("name"), F.lit("not_consecutive").alias("problem")
    )
    repeats = columns.groupBy("name").count().filter(F.col("count") > 1).select(
        "name", F.lit("duplicate_name").alias("problem")
    )
    empty = columns.filter(F.col("name").isNull() | F.col("dtype").isNull()).select(
        "name", F.lit("missing_attribute").alias("problem")
    )
    return gaps.unionByName(repeats).unionByName(empty)


_REFERENCE = "org.apache.spark.sql.catalyst.analysis.UnresolvedAttribute"


def names_in(spark: SparkSession, expression: str) -> list[str] | None:
    """The column names of a check written as text, by Spark's own parser; None if it is not an expression."""
    try:
        tree = spark._jsparkSession.sessionState().sqlParser().parseExpression(expression)
    except Exception as error:  # the gateway's and the parser's own error types
        if "PARSE" not in str(error).upper():
            raise
        return None
    found, left = [], [tree]
    while left:
        node = left.pop()
        if node.getClass().getName() == _REFERENCE:
            found.append(node.name())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return sorted(set(found))


def audit_expressions(
    spark: SparkSession, expressions: dict[str, str], known: Iterable[str], aliases: dict[str, str] | None = None
) -> DataFrame:
    """(rule_id, problem, detail) of checks written as text: ``invalid_expression``, or ``unknown_name`` for every name that is
    neither a known column nor an alias of one. The expressions are a catalogue on the driver."""
    columns = set(known)
    names = R.COLUMN_ALIASES if aliases is None else aliases
    rows = []
    for rule, text in expressions.items():
        found = names_in(spark, text)
        if found is None:
            rows.append((rule, "invalid_expression", text))
        else:
            rows += [(rule, "unknown_name", n) for n in found if names.get(n, n) not in columns]
    return spark.createDataFrame(rows, "rule_id string, problem string, detail string")


REQUIRED_KEYS = ("position", "name", "dtype", "nullable", "column_group")


def audit_attributes(columns: DataFrame, required: Iterable[str] = REQUIRED_KEYS, name: str = "name") -> DataFrame:
    """(name, problem) where a contract row lacks a required attribute, or the table lacks its column."""
    absent = [k for k in required if k not in columns.columns]
    rows = [F.when(F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == ""), F.lit(f"missing_{k}")) for k in required if k not in absent]
    held = columns.select(F.col(name).cast("string").alias("name"), F.explode(F.array_compact(F.array(*rows))).alias("problem")) if rows else None
    told = columns.sparkSession.createDataFrame([("table", f"missing_{k}") for k in absent], "name string, problem string")
    return told if held is None else held.unionByName(told)
