"""Exact quantiles, moments and robust statistics per group, from one table of values and counts.

Values are first reduced to (group, value, count): the map side combines, and a hot group is spread over
tasks by value. That table is then exchanged once by group and sorted by value; the running count
gives the rank of every value, so quantiles are picked by rank and no group's values are held in
memory. Deviations from the median are sorted where they are, so the MAD needs no further exchange. Measured
values carry a fixed number of decimals, so the table of a group is as wide as the sensor's resolution.

Deviations are taken about the group's least value: sums of squares of large values would cancel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Years are counted by one bit each, modulo so many; the years of one group span less.
YEAR_BITS = 256


def value_counts(df: DataFrame, keys: list[str], value: str, also: dict[str, Column] | None = None) -> DataFrame:
    """(keys, _x, _n) with one row a value; null counts as a value. ``also`` adds further aggregates."""
    return df.groupBy(*keys, F.col(value).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in (also or {}).items()]
    )


def year_bits(year: str) -> dict[str, Column]:
    """Aggregates that mark the years of a value; :func:`count_years` counts those of a group."""
    word = F.floor(F.pmod(F.col(year).cast("long"), F.lit(YEAR_BITS)) / 64)
    bit = F.expr(f"shiftleft(1L, CAST(pmod(CAST(`{year}` AS BIGINT), 64) AS INT))")
    return {f"_y{i}": F.bit_or(F.when(word == i, bit)) for i in range(YEAR_BITS // 64)}


def count_years() -> Column:
    marked = [F.coalesce(F.bit_count(F.bit_or(F.when(F.col("_x").isNotNull(), F.col(f"_y{i}")))), F.lit(0)) for i in range(YEAR_BITS // 64)]
    return sum(marked[1:], marked[0]).cast("bigint")


class Ranked:
    """The (value, count) rows of every group in order, with the counts up to each row."""

    def __init__(self, counts: DataFrame, keys: list[str]) -> None:
        self.keys = keys
        self.group = W.partitionBy(*keys)
        valid = F.when(F.col("_x").isNotNull(), F.col("_n")).otherwise(0)
        self.rows = self._up_to(counts.withColumn("_v", valid), "_x", "_upto").withColumns(
            {"_size": F.sum("_v").over(self.group), "_low": F.min("_x").over(self.group)}
        )

    def _up_to(self, rows: DataFrame, value: str, name: str) -> DataFrame:
        ordered = self.group.orderBy(F.col(value).asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
        return rows.withColumn(name, F.sum("_v").over(ordered))

    @staticmethod
    def _pick(value: str, upto: str, p: float, fold) -> Column:
        """The quantile between its two neighbours in rank; ``fold`` makes an aggregate of the one row that holds a rank."""
        position = (F.col("_size") - 1) * F.lit(float(p))

        def at(rank: Column) -> Column:
            held = (F.col(upto) > rank) & (F.col(upto) - F.col("_v") <= rank)
            return fold(F.when(held & (F.col("_v") > 0), F.col(value)))

        low, high = at(F.floor(position)), at(F.ceil(position))
        part = fold(position - F.floor(position))
        return low + (high - low) * part

    def quantile(self, p: float) -> Column:
        return self._pick("_x", "_upto", p, F.max)

    def with_deviations(self) -> Ranked:
        """Rows that also carry their distance from the median and the counts up to it."""
        median = self._pick("_x", "_upto", 0.5, lambda c: F.max(c).over(self.group))
        self.rows = self._up_to(self.rows.withColumn("_away", F.round(F.abs(F.col("_x") - median), 9)), "_away", "_upto_away")
        return self

    def mad(self) -> Column:
        return self._pick("_away", "_upto_away", 0.5, F.max)

    @staticmethod
    def moments() -> dict[str, Column]:
        """n, mean, std, minimum and maximum of a group."""
        x, n = F.col("_x"), F.col("_v")
        c, size, low = x - F.col("_low"), F.sum(n), F.min(x)
        first, second = F.sum(c * n), F.sum(c * c * n)
        spread = F.sqrt(F.greatest(second - first * first / size, F.lit(0.0)) / (size - 1))
        return {
            "n": size, "mean": F.sum(x * n) / size, "std": F.when(size > 1, F.when(low == F.max(x), F.lit(0.0)).otherwise(spread)),
            "minimum": low, "maximum": F.max(x),
        }

    def agg(self, columns: dict[str, Column]) -> DataFrame:
        return self.rows.groupBy(*self.keys).agg(*[c.alias(n) for n, c in columns.items()])


def quantiles_of_counts(counts: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """One row per group with the named quantiles (linear interpolation) of a (keys, _x, _n) table."""
    ranked = Ranked(counts, keys)
    return ranked.agg({n: ranked.quantile(p) for n, p in probs.items()})


def robust_statistics(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float] | None = None, year: str | None = None
) -> DataFrame:
    """n, mean, std, minimum, maximum, the named quantiles, median and MAD per group, and its number of years.

    Groups without a value are left out.
    """
    counts = value_counts(df.filter(F.col(value).isNotNull()), keys, value, year_bits(year) if year else None)
    ranked = Ranked(counts, keys).with_deviations()
    named = {n: ranked.quantile(p) for n, p in {"median": 0.5, **(probs or {})}.items()}
    years = {"years": count_years()} if year else {}
    return ranked.agg({**ranked.moments(), **named, "mad": ranked.mad(), **years})
