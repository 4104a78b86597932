"""Joins: dimensions, thresholds, neighbours and time-tolerant matches.

Dimension sides carry no broadcast hint: Spark broadcasts them when their measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by key, where adaptive execution
splits a skewed key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsguard.functions import scalars as S


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other; right's key columns are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = S.all_of([F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def one_row_each(dimension: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key of a dimension, the least by its other columns: a key listed twice must not
    multiply what is joined to it."""
    rest = [c for c in dimension.columns if c not in key]
    if not rest:
        return dimension.distinct()
    least = dimension.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(*key, *[F.col(f"_least.{c}").alias(c) for c in rest])


def enrich_from_stations(
    obs: DataFrame, stations: DataFrame, key: str = "station_id", fields: list[str] | None = None
) -> DataFrame:
    """Left join to the station dimension: adds ``station_known`` and the wanted fields.

    A field the observation already has is only filled where it is null.
    """
    fields = fields or [c for c in stations.columns if c != key]
    right = one_row_each(
        stations.select(F.upper(F.trim(F.col(key))).alias("_sid"), *[F.col(f).alias(f"_s_{f}") for f in fields]), ["_sid"]
    )
    out = obs.join(right, F.upper(F.trim(F.col(key))) == F.col("_sid"), "left")
    out = out.withColumn("station_known", F.col("_sid").isNotNull())
    for f in fields:
        filled = F.coalesce(F.col(f), F.col(f"_s_{f}")) if f in obs.columns else F.col(f"_s_{f}")
        out = out.withColumn(f, filled)
    return out.drop("_sid", *[f"_s_{f}" for f in fields])


def unknown_members(obs: DataFrame, dimension: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows whose key is set but absent from the dimension."""
    return obs.filter(F.col(key).isNotNull()).join(
        dimension.select(F.col(dim_key).alias(key)), key, "left_anti"
    )


def resolve_units(df: DataFrame, unit_col: str, aliases: DataFrame, units: DataFrame) -> DataFrame:
    """Add unit_id, base_unit, factor, offset, precision of a unit spelled in any known way."""
    table = aliases.join(units, "unit_id").select(
        F.col("alias").alias("_alias"), "unit_id", "base_unit", "factor", "offset", "precision"
    )
    return df.join(one_row_each(table, ["_alias"]), F.col(unit_col) == F.col("_alias"), "left").drop("_alias")


def with_limits(long_df: DataFrame, limits: DataFrame, on: list[str]) -> DataFrame:
    """Left join of caller-supplied limits or thresholds; absent rows leave nulls (NOT_CHECKED)."""
    return long_df.join(one_row_each(limits, on), on, "left")


def _cells(lat, lon, radius_km: float):
    """Cube cell of a point on the sphere, edge = radius: points closer than it lie in adjacent cells."""
    phi, lam = F.radians(lat), F.radians(lon)
    r = S.EARTH_RADIUS_KM / radius_km
    return (
        F.floor(F.cos(phi) * F.cos(lam) * r).cast("int"),
        F.floor(F.cos(phi) * F.sin(lam) * r).cast("int"),
        F.floor(F.sin(phi) * r).cast("int"),
    )


def neighbour_pairs(
    stations: DataFrame, max_km: float = 300.0, key: str = "station_id", lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """(station, neighbour, distance_km) for all ordered pairs within ``max_km``.

    An equi-join on cube cells (one side copied to the 27 cells around it) keeps the exact
    distance test to nearby candidates only.
    """
    x, y, z = _cells(F.col(lat), F.col(lon), max_km)
    here = stations.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.col(key).alias("station"), F.col(lat).alias("_lat1"), F.col(lon).alias("_lon1"),
        x.alias("_x"), y.alias("_y"), z.alias("_z"),
    )
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    there = here.select(
        F.col("station").alias("neighbour"), F.col("_lat1").alias("_lat2"), F.col("_lon1").alias("_lon2"),
        "_x", "_y", "_z",
    )
    for axis in ("_x", "_y", "_z"):
        there = there.withColumn("_d", F.explode(step)).withColumn(axis, F.col(axis) + F.col("_d")).drop("_d")
    d = S.haversine_km(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))
    return (
        here.join(there, ["_x", "_y", "_z"])
        .filter(F.col("station") != F.col("neighbour"))
        .withColumn("distance_km", d)
        .filter(F.col("distance_km") <= max_km)
        .select("station", "neighbour", "distance_km")
    )


def nearest_in_time(
    probes: DataFrame,
    observations: DataFrame,
    pairs: DataFrame,
    tolerance_s: int = 1800,
    key: str = "station_id",
    ts: str = "ts",
    row_id: str = "event_id",
    value: str = "value",
) -> DataFrame:
    """For every probe and every paired station: the observation closest in time within the tolerance.

    Ties in distance go to the earlier time, ties in time to the smaller row id. Time is cut into
    buckets of one tolerance. From the bucket before only its last row can be nearest and from the
    bucket after only its first row; both come from an aggregate of one row per (station, bucket).
    Inside a bucket, probes and observations are merged in time order, so no pairs are formed.
    Returns probe id, station, neighbour, neighbour row id, neighbour value, gap in microseconds.
    """
    width = tolerance_s * 1_000_000
    t = S.epoch_us(F.col(ts))
    obs = observations.filter(F.col(value).isNotNull()).select(
        F.col(key).alias("neighbour"), t.alias("_t"), F.col(row_id).alias("_id"), F.col(value).alias("_v"),
        F.floor(t / F.lit(width)).cast("bigint").alias("_b"),
    )
    me = F.struct("_t", F.col("_id").alias("_id"), F.col("_v").alias("_v"))
    # The later of equal times is the one with the smaller id, so the id is negated for the maximum.
    ends = obs.groupBy("neighbour", "_b").agg(
        F.min(me).alias("first"), F.max_by(me, F.struct(F.col("_t"), -F.col("_id"))).alias("last")
    )
    asks = (
        probes.select(
            F.col(key).alias("station"), F.col(row_id).alias("_pid"), t.alias("_pt"),
            F.floor(t / F.lit(width)).cast("bigint").alias("_b"),
        )
        .join(pairs.select("station", "neighbour"), "station")
    )
    merged = asks.select(
        "neighbour", "_b", F.col("_pt").alias("_t"), "station", "_pid", F.lit(None).cast(obs.schema["_id"].dataType).alias("_id"),
        F.lit(None).cast(obs.schema["_v"].dataType).alias("_v"),
    ).unionByName(
        obs.select(
            "neighbour", "_b", "_t", F.lit(None).cast(asks.schema["station"].dataType).alias("station"),
            F.lit(None).cast(asks.schema["_pid"].dataType).alias("_pid"), "_id", "_v",
        )
    )
    mine = F.when(F.col("_id").isNotNull(), me)
    # Equal times: observations before probes; among observations the smaller id last, so it is the one seen.
    forward = W.partitionBy("neighbour", "_b").orderBy("_t", F.col("_id").desc_nulls_last())
    back = W.partitionBy("neighbour", "_b").orderBy(F.col("_t").desc(), F.col("_id").desc_nulls_last())
    inside = (
        merged.withColumns(
            {
                "before": F.last(mine, ignorenulls=True).over(forward.rowsBetween(W.unboundedPreceding, 0)),
                "after": F.last(mine, ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, 0)),
            }
        )
        .filter(F.col("_pid").isNotNull())
    )
    prev = ends.select("neighbour", (F.col("_b") + 1).alias("_b"), F.col("last").alias("prev"))
    nxt = ends.select("neighbour", (F.col("_b") - 1).alias("_b"), F.col("first").alias("next"))
    every = inside.join(prev, ["neighbour", "_b"], "left").join(nxt, ["neighbour", "_b"], "left")
    candidates = F.array_compact(F.array("prev", "before", "after", "next"))
    scored = F.transform(
        candidates,
        lambda c: F.struct(
            F.abs(c["_t"] - F.col("_t")).alias("gap"), c["_t"].alias("t"), c["_id"].alias("id"), c["_v"].alias("v")
        ),
    )
    best = F.array_min(F.filter(scored, lambda c: c["gap"] <= width))
    return (
        every.withColumn("_best", best)
        .filter(F.col("_best").isNotNull())
        .select(
            F.col("_pid").alias(row_id), "station", "neighbour", F.col("_best.id").alias("neighbour_id"),
            F.col("_best.v").alias("neighbour_value"), F.col("_best.gap").alias("gap_us"),
        )
    )


#: Edge of a cube in which places are dealt to tasks, in reaches, and length of a span of time, in tolerances.
DEAL_REACHES = 4
DEAL_TOLERANCES = 12
#: Rows a task gathers before it matches them, and candidates it looks at in one go.
MATCH_ROWS = 100_000
MATCH_CANDIDATES = 1_000_000


def nearest_around(
    probes: DataFrame,
    observations: DataFrame,
    stations: DataFrame,
    max_km: float = 300.0,
    tolerance_s: int = 1800,
    key: str = "station_id",
    ts: str = "ts",
    row_id: str = "event_id",
    value: str = "value",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """(row_id, station, matches): for every probe, of each station within ``max_km`` the observation closest in time.

    The same matches as :func:`nearest_in_time` over :func:`neighbour_pairs`, in one array a probe. Rows are dealt by
    place and time: a probe goes to the one cube and span of time it lies in, an observation to those it can be matched
    in, a few whatever the number of stations. Neither pairs of stations nor matches are exchanged. Inside a task rows
    come in time order, and only those within the tolerance of a probe still to be matched are held.
    """
    width = tolerance_s * 1_000_000
    edge, span = DEAL_REACHES * max_km, DEAL_TOLERANCES * width
    places = one_row_each(
        stations.filter(F.col(key).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
            F.col(key).alias("station"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")
        ),
        ["station"],
    )

    def timed(df: DataFrame, probe: bool) -> DataFrame:
        v = F.lit(None).cast(observations.schema[value].dataType) if probe else F.col(value)
        return df.select(
            F.col(key).alias("station"), F.col(row_id).alias("_id"), S.epoch_us(F.col(ts)).alias("_t"), v.alias("_v"),
            F.lit(probe).alias("_probe"),
        ).filter(F.col("_t").isNotNull())

    rows = timed(probes, True).unionByName(timed(observations.filter(F.col(value).isNotNull()), False))
    phi, lam = F.radians("_lat"), F.radians("_lon")
    axes = {"_x": F.cos(phi) * F.cos(lam), "_y": F.cos(phi) * F.sin(lam), "_z": F.sin(phi)}
    # a hair more than the reach, so that no rounding keeps a pair apart
    reach = F.when(F.col("_probe"), F.lit(0.0)).otherwise(F.lit(max_km * (1 + 1e-9) + 1e-6))
    late = F.when(F.col("_probe"), F.lit(0)).otherwise(F.lit(width))
    dealt = rows.join(places, "station").withColumn(
        "_span", F.explode(F.sequence(F.floor((F.col("_t") - late) / F.lit(span)), F.floor((F.col("_t") + late) / F.lit(span))))
    )
    for axis, unit in axes.items():
        at = unit * F.lit(S.EARTH_RADIUS_KM)
        dealt = dealt.withColumn(axis, F.explode(F.sequence(F.floor((at - reach) / F.lit(edge)), F.floor((at + reach) / F.lit(edge)))))
    cells = 2 * math.ceil((S.EARTH_RADIUS_KM + max_km) / edge) + 3
    deal = ["_cube", "_span"]
    dealt = dealt.select(
        ((F.col("_x") * cells + F.col("_y")) * cells + F.col("_z")).alias("_cube"), "_span", "_t", "_id", "_probe", "station", "_v", "_lat", "_lon"
    )
    match = T.StructType(
        [
            T.StructField("neighbour", dealt.schema["station"].dataType), T.StructField("neighbour_id", dealt.schema["_id"].dataType),
            T.StructField("neighbour_value", dealt.schema["_v"].dataType), T.StructField("gap_us", T.LongType()),
        ]
    )
    schema = T.StructType(
        [
            T.StructField(row_id, dealt.schema["_id"].dataType), T.StructField("station", dealt.schema["station"].dataType),
            T.StructField("matches", T.ArrayType(match)),
        ]
    )
    return dealt.repartition(*deal).sortWithinPartitions(*deal, "_t", "_id").mapInArrow(_matcher(row_id, max_km, width), schema)


def _matcher(row_id: str, max_km: float, width: int):
    """The part of :func:`nearest_around` inside a task, over rows sorted by cube, span, time and id."""
    radius, rows_held, candidates_held = S.EARTH_RADIUS_KM, MATCH_ROWS, MATCH_CANDIDATES

    def match(batches):
        import numpy as np
        import pyarrow as pa

        def found(held, final):
            """Yields the matches of the probes whose time has passed; returns the rows to go on with."""
            rows = pa.Table.from_batches(held)
            here = {c: rows[c].combine_chunks() for c in ("station", "_id", "_v")}
            n = rows.num_rows
            column = {c: rows[c].to_numpy() for c in ("_cube", "_span", "_t", "_lat", "_lon", "_probe")}
            t, probe = column["_t"], column["_probe"].astype(bool)
            new = np.r_[True, (np.diff(column["_cube"]) != 0) | (np.diff(column["_span"]) != 0)]
            group = np.cumsum(new) - 1
            last, end = group[-1], t[-1]
            open_ = np.zeros(n, bool) if final else (group == last) & (t + width >= end)
            station = here["station"].dictionary_encode().indices.to_numpy()
            # one ascending number for group and time: groups lie more than the tolerance apart
            start = t[new][group]
            length = int((t - start).max()) + 2 * width + 2
            at = group * length + (t - start)
            obs = np.flatnonzero(~probe)
            ask = np.flatnonzero(probe & ~open_)
            low = np.searchsorted(at[obs], at[ask] - width, "left")
            high = np.searchsorted(at[obs], at[ask] + width, "right")
            total = np.cumsum(high - low)
            phi, lam = np.radians(column["_lat"]), np.radians(column["_lon"])
            x, y, z, cos = np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi), np.cos(phi)
            least = np.cos(min(max_km / radius * (1 + 1e-6) + 1e-6, np.pi))
            first = 0
            while first < len(ask):
                done = total[first - 1] if first else 0
                stop = max(first + 1, int(np.searchsorted(total, done + candidates_held, "right")))
                count = (high - low)[first:stop]
                i = np.repeat(ask[first:stop], count)
                j = obs[np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[first:stop], count)]
                first = stop
                near = (x[i] * x[j] + y[i] * y[j] + z[i] * z[j] >= least) & (station[i] != station[j])
                i, j = i[near], j[near]
                a = np.sin((phi[j] - phi[i]) / 2) ** 2 + cos[i] * cos[j] * np.sin((lam[j] - lam[i]) / 2) ** 2
                near = np.arcsin(np.sqrt(np.minimum(a, 1.0))) * (2 * radius) <= max_km
                i, j = i[near], j[near]
                if not len(i):
                    continue
                # of a probe and a station the least gap; among equal gaps the row that comes first by time and id
                gap = np.abs(t[j] - t[i])
                order = np.lexsort((gap, station[j], i))
                i, j, gap = i[order], j[order], gap[order]
                best = np.r_[True, (np.diff(i) != 0) | (np.diff(station[j]) != 0)]
                i, j, gap = i[best], j[best], gap[best]
                heads = np.flatnonzero(np.r_[True, np.diff(i) != 0])
                matches = pa.StructArray.from_arrays(
                    [here["station"].take(pa.array(j)), here["_id"].take(pa.array(j)), here["_v"].take(pa.array(j)), pa.array(gap)],
                    ["neighbour", "neighbour_id", "neighbour_value", "gap_us"],
                )
                lists = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(i)].astype("int32")), matches)
                heads = pa.array(i[heads])
                yield pa.RecordBatch.from_arrays([here["_id"].take(heads), here["station"].take(heads), lists], [row_id, "station", "matches"])
            still = (group == last) & np.where(probe, open_, t >= end - 2 * width)
            return rows.filter(pa.array(still)).to_batches()

        held, waiting, enough = [], 0, rows_held
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= enough:
                held = yield from found(held, False)
                waiting = sum(b.num_rows for b in held)
                enough = max(rows_held, 2 * waiting)
        if waiting:
            yield from found(held, True)

    return match


def with_provenance(records: DataFrame, inventory: DataFrame, path: str = "source_file") -> DataFrame:
    """Attach the content hash of the file a record came from."""
    return records.join(
        inventory.select(F.col("path").alias(path), F.col("sha256").alias("source_hash")), path, "left"
    )
