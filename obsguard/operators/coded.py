"""Results of a whole run as one small code per check.

A run over all rules makes hundreds of results an observation, nearly all of them PASS. They are kept as an
array of one byte each, in the fixed order of the run's checks; rule, variable and message follow
from the place in the array. So an observation carries its results through every later stage for a few
hundred bytes, and names are spelled out only for what failed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.catalogs import rulebook as R
from obsguard.operators.framework import FAILED, Check

#: Code of a flag: its place in the order of severity, from 1; the failed ones come first.
CODES = {flag: i + 1 for i, flag in enumerate(R.FLAG_ORDER)}
LAST_FAILED = max(CODES[f] for f in FAILED)
_FLAG_LIST = ",".join(R.FLAG_ORDER)


@dataclass(frozen=True)
class Item:
    """What a place in the code array stands for."""

    rule_id: str
    variable: str = ""


class Results:
    """A frame under evaluation and the checks made so far; every ``add`` is one projection."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self.items: list[Item] = []
        self.parts: list[str] = []

    def add(self, checks: list[Check], drop: list[str] | None = None) -> Results:
        """Evaluate ``checks`` on the present columns; ``drop`` names columns that are not needed after."""
        if checks:
            part = f"_codes{len(self.parts)}"
            codes = F.array(*[F.find_in_set(c.flag, F.lit(_FLAG_LIST)).cast("tinyint") for c in checks])
            self.df = self.df.withColumn(part, codes)
            self.parts.append(part)
            self.items += [Item(c.rule_id, c.variable) for c in checks]
        self.df = self.df.drop(*(drop or []))
        return self

    def transform(self, step, *args, **kwargs) -> Results:
        self.df = step(self.df, *args, **kwargs)
        return self

    def finish(self, into: str = "qc_codes") -> tuple[DataFrame, list[Item]]:
        return self.df.withColumn(into, F.concat(*self.parts)).drop(*self.parts), self.items


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def flag_of(code: Column) -> Column:
    return F.element_at(_names(R.FLAG_ORDER), code.cast("int"))


def count_code(codes: Column, flag: str) -> Column:
    return F.size(codes) - F.size(F.array_remove(codes, F.lit(CODES[flag]).cast("tinyint")))


def assess_codes(df: DataFrame, items: list[Item], codes: str = "qc_codes") -> DataFrame:
    """Per-observation outcome, as ``framework.assess`` gives it: status, score, counts, failed rules, messages."""
    found = F.col(codes)
    lost = sum((count_code(found, flag) * points for flag, points in R.SCORE_PENALTIES.items()), F.lit(0))
    # a failed check as one number, place and flag; passing ones give null and drop out. Codes are gone through once,
    # the few that failed are then looked up
    failed = F.array_compact(F.transform(found, lambda c, i: F.when(c <= LAST_FAILED, i * LAST_FAILED + c.cast("int") - 1)))
    flags = sorted(FAILED, key=CODES.get)
    rules = _names([i.rule_id for i in items for _ in flags])
    said = _names([f"{i.rule_id}: {f.lower()}" for i in items for f in flags])
    return df.withColumn("_failed", failed).withColumns(
        {
            "qc_flag": flag_of(F.array_min(found)),
            "qc_score": F.greatest(F.lit(0), F.least(F.lit(R.SCORE_START), F.lit(R.SCORE_START) - lost)).cast("float"),
            "qc_rule_count": F.size(found),
            "qc_failed_rule_count": sum((count_code(found, f) for f in FAILED), F.lit(0)),
            "qc_messages": F.array_join(F.transform("_failed", lambda k: said[k]), "; "),
            "qc_flags": F.sort_array(F.array_distinct(F.transform("_failed", lambda k: rules[k]))),
        }
    ).withColumn("qc_status", F.col("qc_flag")).drop("_failed")


def code_counts(df: DataFrame, keys: list[str], items: list[Item], codes: str = "qc_codes") -> DataFrame:
    """(keys, variable, rule_id, flag, observations): the finest table of a run's summaries.

    Codes are counted by place; names are put to the counted rows, so nothing is joined and no text is exchanged.
    Where there are keys, rows are first brought together by them while a row is still one array: a task then
    counts a few keys in a small table, where scattered rows would send on nearly every code. They are dealt by
    a hash that the grouping does not know, so a key with a third of all rows may be split and its counts added up.
    """
    rows = df.select(*keys, codes)
    if keys:
        rows = rows.withColumn("_spot", F.xxhash64(*keys)).hint("rebalance", "_spot")
    counted = rows.select(*keys, F.posexplode(codes).alias("_place", "_code")).groupBy(*keys, "_place", "_code").agg(
        F.count(F.lit(1)).alias("observations")
    )
    place = F.col("_place") + 1
    return counted.select(
        *keys, F.element_at(_names([i.variable for i in items]), place).alias("variable"),
        F.element_at(_names([i.rule_id for i in items]), place).alias("rule_id"), flag_of(F.col("_code")).alias("flag"), "observations",
    )


def code_detail(
    df: DataFrame, ids: list[str], items: list[Item], codes: str = "qc_codes", failed_only: bool = True
) -> DataFrame:
    """(ids, rule_id, variable, flag, severity, observed_value, message): one row per finding.

    The observed value is looked up for findings only, among the columns that the checks name.
    """
    seen = sorted({i.variable for i in items if i.variable in df.columns})
    values = F.create_map(*[x for c in seen for x in (F.lit(c), F.col(c).cast("string"))]) if seen else F.lit(None)
    rows = df.select(*ids, values.alias("_values"), F.posexplode(codes).alias("_place", "_code"))
    if failed_only:
        rows = rows.filter(F.col("_code") <= LAST_FAILED)
    place, flag = F.col("_place") + 1, flag_of(F.col("_code"))
    named = rows.select(
        *ids, F.element_at(_names([i.rule_id for i in items]), place).alias("rule_id"),
        F.element_at(_names([i.variable for i in items]), place).alias("variable"), flag.alias("flag"), "_values",
    )
    severity = F.element_at(F.create_map(*[F.lit(x) for kv in R.FLAG_SEVERITY.items() for x in kv]), F.col("flag"))
    observed = F.try_element_at(F.col("_values"), F.col("variable")) if seen else F.lit(None).cast("string")
    return named.select(
        *ids, "rule_id", "variable", "flag", severity.alias("severity"),
        F.when(F.col("flag").isin(*FAILED), observed).alias("observed_value"),
        F.when(F.col("flag").isin(*FAILED), F.concat("rule_id", F.lit(": "), F.lower("flag"))).alias("message"),
    )
