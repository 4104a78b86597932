"""Joins: dimensions, thresholds, neighbours, time-tolerant matches, provenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.q_checks import LIMITS, UNIT_CTE, _UNIT_VALUES, _blank, limits
from coverage_queries.q_functions import _HAVERSINE
from coverage_queries.registry import query, register
from obsguard.catalogs import dimensions as dim
from obsguard.operators import joins as J
from obsguard.operators.references import spatial_flags


@query(
    "jon_01_station_enrichment",
    f"""WITH {B.WIDE_CTE}, {B.OPEN_STATION_CTE} SELECT o.event_id, s.station_id IS NOT NULL AS station_known, s.aerodrome_name, s.timezone,
    coalesce(o.elevation_m, s.elevation_m) AS elevation_m FROM obs o LEFT JOIN stations s ON upper(trim(o.station_id)) = s.station_id""",
)
def enrichment(spark, sf_dir):
    fields = ["aerodrome_name", "timezone", "elevation_m"]
    out = J.enrich_from_stations(B.wide(spark, sf_dir), B.stations(spark, sf_dir, open_only=True), fields=fields)
    return out.select("event_id", "station_known", *fields)


@query(
    "jon_02_code_list_membership",
    f"""WITH {B.WIDE_CTE} SELECT event_id, cloud_amount_1 FROM obs WHERE cloud_amount_1 IS NOT NULL AND cloud_amount_1 NOT IN
    ('SKC','CLR','FEW','SCT','BKN','OVC','NSC','NCD','VV')""",
)
def membership(spark, sf_dir):
    domain = dim.descriptors(spark).filter("domain = 'cloud_codes'")
    out = J.unknown_members(B.wide(spark, sf_dir), domain, "cloud_amount_1", "code")
    return out.select("event_id", "cloud_amount_1")


@query(
    "jon_03_unit_aliases",
    f"WITH {UNIT_CTE}, {_UNIT_VALUES} SELECT g.event_id, g.unit, u.unit_id, u.base_unit, CAST(u.factor AS DOUBLE) AS factor FROM given g LEFT JOIN u ON g.unit = u.alias",
)
def units(spark, sf_dir):
    from coverage_queries.q_checks import UNIT_BINDING

    given = B.base(spark, sf_dir).selectExpr("event_id", f"{UNIT_BINDING['unit']} AS unit")
    out = J.resolve_units(given, "unit", dim.unit_aliases(spark), dim.units(spark))
    return out.select("event_id", "unit", "unit_id", "base_unit", "factor")


@query(
    "jon_08_limits_lookup",
    f"""WITH {B.LONG_CTE}, lim(variable, phys_min, phys_max) AS (VALUES {", ".join(f"('{v}', {a}, {b})" for v, a, b, *_ in LIMITS)})
    SELECT event_id, CAST(phys_min AS DOUBLE) AS phys_min, CAST(phys_max AS DOUBLE) AS phys_max FROM long LEFT JOIN lim USING (variable)""",
)
def limit_lookup(spark, sf_dir):
    out = J.with_limits(B.long(spark, sf_dir), limits(spark), ["variable"])
    return out.select("event_id", "phys_min", "phys_max")


@query(
    "jon_09_provenance",
    """WITH files AS (SELECT doc_id, sha256(text) AS source_hash FROM documents)
    SELECT l.doc_id, l.quality, f.source_hash FROM labels l LEFT JOIN files f USING (doc_id)""",
)
def provenance(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents")
    inventory = docs.select(F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha256"))
    records = B.table(spark, sf_dir, "labels").withColumn("source_file", F.col("doc_id").cast("string"))
    return J.with_provenance(records, inventory).select("doc_id", "quality", "source_hash")


# --- neighbours ---------------------------------------------------------------------------------

# Stations that report, with their coordinates.
_NET_CTE = (
    f"{B.STATION_CTE}, net AS (SELECT * FROM stations WHERE user_id IN (SELECT DISTINCT user_id FROM events)),"
    f" pairs AS (SELECT a.user_id AS station, b.user_id AS neighbour,"
    f" {_HAVERSINE.format(a='a.latitude', b='b.latitude', c='a.longitude', d='b.longitude')} AS distance_km"
    " FROM net a JOIN net b ON a.user_id <> b.user_id AND abs(a.latitude - b.latitude) < 3)"
)
_NEAR = "near AS (SELECT * FROM pairs WHERE distance_km <= 300)"


def network(spark, sf_dir):
    reporting = B.table(spark, sf_dir, "events").select("user_id").distinct()
    return B.stations(spark, sf_dir).drop("station_id").join(reporting, "user_id", "left_semi")


def pairs(spark, sf_dir):
    return J.neighbour_pairs(network(spark, sf_dir), 300.0, key="user_id")


@query(
    "jon_06_neighbour_pairs",
    f"WITH {_NET_CTE}, {_NEAR} SELECT station, neighbour, round(distance_km, 6) AS distance_km FROM near",
)
def neighbours(spark, sf_dir):
    return pairs(spark, sf_dir).select("station", "neighbour", F.round("distance_km", 6).alias("distance_km"))


_MATCH_CTE = f"""{_NET_CTE}, {_NEAR}, cand AS (SELECT e.event_id, e.user_id, e.value, n.neighbour, o.event_id AS oid, o.value AS ovalue,
    abs(epoch_us(o.ts) - epoch_us(e.ts)) AS gap, o.ts AS ots FROM events e JOIN near n ON n.station = e.user_id
    JOIN events o ON o.user_id = n.neighbour AND o.ts BETWEEN e.ts - INTERVAL 30 MINUTE AND e.ts + INTERVAL 30 MINUTE),
  matched AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY event_id, neighbour ORDER BY gap, ots, oid) = 1)"""


def matches(spark, sf_dir):
    # One array of matches a row: neither pairs of stations nor matches are exchanged; see nearest_around.
    events = B.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    places = B.stations(spark, sf_dir).select("user_id", "latitude", "longitude")
    return J.nearest_around(events, events, places, 300.0, 1800, key="user_id")


@query(
    "jon_07_nearest_neighbour_observation",
    f"WITH {_MATCH_CTE} SELECT event_id, neighbour, oid AS neighbour_id, ovalue AS neighbour_value, gap AS gap_us FROM matched",
)
def nearest(spark, sf_dir):
    return matches(spark, sf_dir).select("event_id", F.inline("matches"))


_SPATIAL_CTE = f"""{_MATCH_CTE}, around AS (SELECT event_id, count(*) AS n, quantile_cont(ovalue, 0.5) AS med, min(ovalue) AS lo, max(ovalue) AS hi
    FROM matched GROUP BY event_id)"""
_FEW = "WHEN coalesce(n, 0) < 2 THEN 'NOT_CHECKED'"
_SPATIAL_SQL = {
    "spatial_neighbor_difference": "round(abs(value - med), 6) > 40",
    "spatial_isolated_extreme": "round(lo - value, 6) > 40 OR round(value - hi, 6) > 40",
}
for _rule, _test in _SPATIAL_SQL.items():
    register(
        f"rule_{_rule}",
        (
            lambda r: lambda spark, sf_dir: spatial_flags(
                B.table(spark, sf_dir, "events").select("event_id", "value"), matches(spark, sf_dir), 40.0
            ).select("event_id", "neighbours", F.col(r).alias("flag"))
        )(_rule),
        f"""WITH {_SPATIAL_CTE} SELECT e.event_id, coalesce(n, 0) AS neighbours, CASE {_FEW} WHEN {_test} THEN 'SUSPECT' ELSE 'PASS' END AS flag
        FROM events e LEFT JOIN around USING (event_id)""",
    )
