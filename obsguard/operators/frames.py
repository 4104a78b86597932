"""Row frames over ordered groups that stay bounded when one group holds most of the data.

``Window.partitionBy(station)`` puts a whole station into one task. The frames the checks need reach
only a few rows to either side, so every group is cut along its order into slices of fixed width:

1. a row's slice is its order value divided by a width (a span of time, a range of numbers); rows
   without a time are sliced by the next order column, so they do not gather in one place;
2. slices are evaluated on their own, and the rows within reach of a cut once more in a stitched
   sequence that holds only the first and last rows of every slice, which a calendar bounds;
3. a slice of few rows would be all edge: it goes into the stitched sequence whole and is evaluated there only,
   so an ordinary station costs one evaluation and not two.

There is one plan for all sizes and no job while it is built. Slices depend on the row alone, so a
recomputed task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsguard.functions import scalars as S

SLICE_DAYS = 30.0
SLICE_NUMBERS = 1_000_000
#: Leading characters by which text ids are sliced; 16 to the power of this many slices for hex digests.
SLICE_CHARACTERS = 3
#: A slice of at most this many times the reach is stitched whole.
WHOLE_REACHES = 32


def _coarse(df: DataFrame, name: str, days: float, numbers: int, characters: int | None) -> Column:
    """A value's slice, ascending with the value; null where the value is."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(S.epoch_us(F.col(name)) / F.lit(days * 86_400e6)).cast("string")
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(F.col(name)) / F.lit(days)).cast("string")
    if isinstance(dtype, T.NumericType):
        return F.floor(F.col(name) / F.lit(numbers)).cast("string")
    return F.col(name) if characters is None else F.substr(F.col(name), F.lit(1), F.lit(characters))


def with_slices(
    df: DataFrame, order: list[str], days: float = SLICE_DAYS, numbers: int = SLICE_NUMBERS
) -> tuple[DataFrame, list[str]]:
    """Add ``_slice0`` and ``_slice1``; the rows of one slice are consecutive in ``order`` within any group.

    The second is set where the first order column is null or is text, which is sliced by its values.
    """
    first = _coarse(df, order[0], days, numbers, None)
    second = F.lit(None).cast("string")
    if len(order) > 1:
        finer = _coarse(df, order[1], days, numbers, SLICE_CHARACTERS)
        second = finer if isinstance(df.schema[order[0]].dataType, T.StringType) else F.when(F.col(order[0]).isNull(), finer)
    return df.withColumns({"_slice0": first, "_slice1": second}), ["_slice0", "_slice1"]


def over_ordered_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    reach: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    days: float = SLICE_DAYS,
    numbers: int = SLICE_NUMBERS,
) -> DataFrame:
    """Apply ``compute(df, window)`` with ``window`` partitioned by ``keys`` and ordered by ``order``.

    ``compute`` adds columns using ``lag``/``lead``/row frames of that window; a result may depend
    on rows at most ``reach`` positions away. ``order`` must identify a row within its group.
    """
    split, cuts = with_slices(df, order, days, numbers)
    sliced = W.partitionBy(*keys, *cuts).orderBy(*order)
    numbered = split.withColumn("_rn", F.row_number().over(sliced)).withColumn(
        "_left", F.count(F.lit(1)).over(W.partitionBy(*keys, *cuts)) - F.col("_rn")
    )
    small = F.col("_rn") + F.col("_left") <= WHOLE_REACHES * reach
    near = (F.col("_rn") <= reach) | (F.col("_left") < reach) | small
    seam = (F.col("_rn") <= 2 * reach) | (F.col("_left") < 2 * reach) | small
    extra = [*cuts, "_rn", "_left"]
    inner = compute(numbered.filter(~small), sliced).filter(~near)
    stitched = compute(numbered.filter(seam), W.partitionBy(*keys).orderBy(*order)).filter(near)
    # a union keeps the aliases below its first member; new names here let Spark drop them in both members alike, so
    # that what lies below the exchange is the same plan twice and runs once
    named = [F.col(f"`{c}`").alias(c) for c in inner.columns if c not in extra]
    return inner.select(*named).unionByName(stitched.drop(*extra))
