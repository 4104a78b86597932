"""Checks that look at one observation only: column expressions, no shuffle.

``row_checks(df, rule_ids)`` builds the checks; a column the frame does not have counts as null, so
the checks that need it report NOT_CHECKED. Differences are rounded to six decimals before they are
compared with a tolerance, so 10.3 - 10.1 is 0.2 and not a little more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.catalogs import dimensions as dim
from obsguard.catalogs import rulebook as R
from obsguard.functions import scalars as S
from obsguard.operators.framework import Check, expression_flag, flag_when

# Tolerances and limits of the row checks.
DEFAULTS = {
    "future_tolerance_minutes": 10,
    "earliest": "1900-01-01 00:00:00",
    "expected_timezone": "UTC",
    "dew_point_tolerance_c": 0.2,
    "wet_bulb_tolerance_c": 0.5,
    "extremes_tolerance_c": 0.5,
    "humidity_tolerance_pct": 5.0,
    "qnh_qfe_tolerance_hpa": 1.0,
    "elevation_tolerance_hpa": 20.0,
    "gust_significance_kt": 10.0,
    "cavok_visibility_m": 10000.0,
    "cavok_cloud_ft": 5000.0,
    "precipitation_tolerance_mm": 0.1,
    "height_exempt": ["NSC", "NCD", "SKC", "VV"],
    "no_cloud": ["NSC", "NCD", "SKC"],
    "clear_sky": ["NSC", "NCD", "SKC", "CLR"],
    "convective": ["CB", "TCU"],
    "weather_vicinity": False,
}

_PRECIPITATION = "|".join(dim.codes("weather_precipitation"))
_BUILDERS: dict[str, Callable] = {}


def _rule(rule_id: str, variable: str, expected: str = ""):
    def keep(fn):
        _BUILDERS[rule_id] = (fn, variable, expected)
        return fn

    return keep


@dataclass(frozen=True)
class _Layer:
    amount: Column
    height: Column
    kind: Column


class _Row:
    """Access to the columns of one frame by name, typed for comparison."""

    def __init__(self, df: DataFrame, params: dict):
        self.df = df
        self.have = set(df.columns)
        self.p = params

    def has(self, name: str) -> bool:
        return name in self.have

    def text(self, name: str) -> Column:
        return F.col(name) if name in self.have else F.lit(None).cast("string")

    def num(self, name: str) -> Column:
        return F.col(name).cast("double") if name in self.have else F.lit(None).cast("double")

    def layers(self) -> list[_Layer]:
        """The three cloud layers; checks over them are spelled out, which keeps them in generated code."""
        return [
            _Layer(
                self.text(f"cloud_amount_{i}"), self.num(f"cloud_base_height_{i}_ft"), self.text(f"cloud_type_{i}")
            )
            for i in (1, 2, 3)
        ]

    def weather(self) -> list[Column]:
        return [self.text(f"present_weather_{i}") for i in (1, 2, 3)]


def _sure(test: Column) -> Column:
    """An unknown test counts as not met."""
    return F.coalesce(test, F.lit(False))


def _some(items: list, test: Callable) -> Column:
    return S.any_of([_sure(test(x)) for x in items])


def _none_set(items: list[Column]) -> Column:
    return S.all_of([x.isNull() for x in items])


def _how_many(conditions: list[Column]) -> Column:
    return sum((c.cast("int") for c in conditions), F.lit(0))


def _over(a: Column, b: Column) -> Column:
    return F.round(a - b, 6)


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def _absent(r: _Row, column: str, flag: str) -> Column:
    """Flag a null or blank value; a frame without the column is not checked."""
    return flag_when(_blank(r.text(column)), flag) if r.has(column) else F.lit("NOT_CHECKED")


# --- identity -----------------------------------------------------------------------------------

_rule("identity_missing_station_id", "station_id", "present")(lambda r, f: _absent(r, "station_id", f))
_rule("identity_missing_source_file", "source_file", "present")(lambda r, f: _absent(r, "source_file", f))
_rule("identity_missing_source_row", "source_row", "present")(lambda r, f: _absent(r, "source_row", f))
_rule("identity_missing_report_type", "report_type", "present")(lambda r, f: _absent(r, "report_type", f))


@_rule("identity_invalid_station_id", "station_id", "known station")
def _station(r, f):
    if not r.has("station_known"):
        return F.lit("NOT_CHECKED")
    return flag_when(~F.col("station_known"), f, skip=_blank(r.text("station_id")))


@_rule("identity_invalid_report_type", "report_type", "known report type")
def _report_type(r, f):
    c = r.text("report_type")
    return flag_when(~c.isin(dim.codes("report_types")), f, [c])


# --- date and time ------------------------------------------------------------------------------

_DATE = ("year", "month", "day")
_PARTS = ("year", "month", "day", "hour_utc", "minute")


@_rule("datetime_missing", "datetime_utc", "all components present")
def _dt_missing(r, f):
    return flag_when(S.any_of([r.num(c).isNull() for c in _PARTS]), f)


@_rule("datetime_invalid_date", "date", "a calendar date")
def _dt_date(r, f):
    y, m, d = (r.num(c).cast("int") for c in _DATE)
    zero = F.lit(0)
    return flag_when(S.datetime_from_parts(y, m, d, zero, zero).isNull(), f, [y, m, d])


@_rule("datetime_invalid_time", "hour_utc", "hour 0-23, minute 0-59")
def _dt_time(r, f):
    h, m = r.num("hour_utc"), r.num("minute")
    return flag_when(~h.between(0, 23) | ~m.between(0, 59), f, [h, m])


@_rule("datetime_invalid_timezone", "datetime_utc", "UTC")
def _dt_zone(r, f):
    c = r.text("timezone_declared")
    return flag_when(c != r.p["expected_timezone"], f, [c])


@_rule("datetime_future", "datetime_utc", "not after the run")
def _dt_future(r, f):
    if r.p.get("as_of") is None or not r.has("datetime_utc"):
        return F.lit("NOT_CHECKED")
    late = S.epoch_us(F.lit(r.p["as_of"]).cast("timestamp_ntz")) + r.p["future_tolerance_minutes"] * 60_000_000
    return flag_when(S.epoch_us(F.col("datetime_utc")) > late, f, [F.col("datetime_utc")])


@_rule("datetime_implausible_historical", "datetime_utc", "not before 1900")
def _dt_old(r, f):
    if not r.has("datetime_utc"):
        return F.lit("NOT_CHECKED")
    first = F.lit(r.p["earliest"]).cast("timestamp_ntz")
    return flag_when(F.col("datetime_utc").cast("timestamp_ntz") < first, f, [F.col("datetime_utc")])


# --- temperature and humidity -------------------------------------------------------------------


@_rule("temperature_dew_point_above_air", "dew_point_temperature_c", "<= air temperature + 0.2")
def _dew(r, f):
    t, td = r.num("air_temperature_c"), r.num("dew_point_temperature_c")
    return flag_when(_over(td, t) > r.p["dew_point_tolerance_c"], f, [t, td])


@_rule("temperature_wet_bulb_inconsistent", "wet_bulb_temperature_c", "dew point <= wet bulb <= air")
def _wet(r, f):
    t, td, tw = r.num("air_temperature_c"), r.num("dew_point_temperature_c"), r.num("wet_bulb_temperature_c")
    tol = r.p["wet_bulb_tolerance_c"]
    low = F.coalesce(_over(td, tw) > tol, F.lit(False))
    high = F.coalesce(_over(tw, t) > tol, F.lit(False))
    return flag_when(low | high, f, skip=tw.isNull() | (t.isNull() & td.isNull()))


@_rule("temperature_daily_extremes_inconsistent", "minimum_temperature_c", "<= maximum")
def _extremes(r, f):
    lo, hi = r.num("minimum_temperature_c"), r.num("maximum_temperature_c")
    return flag_when(lo > hi, f, [lo, hi])


@_rule("temperature_outside_daily_extremes", "air_temperature_c", "within the daily extremes")
def _outside(r, f):
    t, lo, hi = r.num("air_temperature_c"), r.num("minimum_temperature_c"), r.num("maximum_temperature_c")
    tol = r.p["extremes_tolerance_c"]
    return flag_when((_over(lo, t) > tol) | (_over(t, hi) > tol), f, [t, lo, hi])


@_rule("humidity_invalid_range", "relative_humidity_pct", "0-100")
def _humidity(r, f):
    h = r.num("relative_humidity_pct")
    return flag_when(~h.between(0, 100), f, [h])


def _humidity_dew(r, f):
    h, t, td = r.num("relative_humidity_pct"), r.num("air_temperature_c"), r.num("dew_point_temperature_c")
    gap = F.round(F.abs(h - S.relative_humidity(t, td)), 6)
    return flag_when(gap > r.p["humidity_tolerance_pct"], f, [h, t, td])


_rule("humidity_dew_point_inconsistent", "relative_humidity_pct", "agrees with dew point")(_humidity_dew)
_rule("consistency_humidity_dew_point", "relative_humidity_pct", "agrees with dew point")(_humidity_dew)


# --- pressure -----------------------------------------------------------------------------------


@_rule("pressure_qnh_qfe_relationship", "qnh_hpa", ">= QFE - 1.0")
def _qnh(r, f):
    a, b = r.num("qnh_hpa"), r.num("qfe_hpa")
    return flag_when(_over(b, a) > r.p["qnh_qfe_tolerance_hpa"], f, [a, b])


@_rule("pressure_elevation_consistency", "qfe_hpa", "QNH reduced to station height")
def _elevation(r, f):
    qnh, qfe, h = r.num("qnh_hpa"), r.num("qfe_hpa"), r.num("elevation_m")
    reduced = qnh * F.pow(F.lit(1.0) - h * 0.0065 / 288.15, F.lit(5.255))
    return flag_when(F.round(F.abs(qfe - reduced), 6) > r.p["elevation_tolerance_hpa"], f, [qnh, qfe, h])


# --- wind ---------------------------------------------------------------------------------------


@_rule("wind_direction_range", "wind_direction_deg", "0-360")
def _direction(r, f):
    d = r.num("wind_direction_deg")
    return flag_when(~d.between(0, 360), f, [d])


@_rule("wind_variable_direction", "wind_direction_deg", "VRB has no direction")
def _variable(r, f):
    raw = r.text("wind_direction_raw")
    return flag_when(F.upper(F.trim(raw)) == "VRB", f, [raw])


@_rule("wind_calm_consistency", "wind_direction_deg", "0 or none when calm")
def _calm(r, f):
    v, d = r.num("wind_speed_kt"), r.num("wind_direction_deg")
    return flag_when((v <= 0) & d.isNotNull() & (d != 0), f, [v])


@_rule("wind_gust_below_mean_speed", "wind_gust_kt", ">= mean speed")
def _gust(r, f):
    v, g = r.num("wind_speed_kt"), r.num("wind_gust_kt")
    return flag_when(_over(g, v) < 0, f, [v, g])


@_rule("wind_gust_significance", "wind_gust_kt", "at least 10 above mean speed")
def _gust_size(r, f):
    v, g = r.num("wind_speed_kt"), r.num("wind_gust_kt")
    gap = _over(g, v)
    return flag_when((gap >= 0) & (gap < r.p["gust_significance_kt"]), f, [v, g])


@_rule("wind_directional_extremes_inconsistent", "wind_direction_deg", "between the two extremes")
def _sector(r, f):
    d, ccw, cw = (r.num(c) for c in ("wind_direction_deg", "wind_direction_ccw_deg", "wind_direction_cw_deg"))
    one = ccw.isNull() != cw.isNull()
    outside = S.wrap_angle(d - ccw) > S.wrap_angle(cw - ccw)
    nothing = (ccw.isNull() & cw.isNull()) | (ccw.isNotNull() & cw.isNotNull() & d.isNull())
    return flag_when(one | outside, f, skip=nothing)


# --- visibility ---------------------------------------------------------------------------------


@_rule("visibility_minimum_above_prevailing", "minimum_visibility_1_m", "<= prevailing")
def _min_vis(r, f):
    v, a, b = (r.num(c) for c in ("prevailing_visibility_m", "minimum_visibility_1_m", "minimum_visibility_2_m"))
    bad = F.coalesce(a > v, F.lit(False)) | F.coalesce(b > v, F.lit(False))
    return flag_when(bad, f, skip=v.isNull() | (a.isNull() & b.isNull()))


@_rule("visibility_second_minimum_without_first", "minimum_visibility_2_m", "needs the first minimum")
def _second(r, f):
    a, b = r.num("minimum_visibility_1_m"), r.num("minimum_visibility_2_m")
    return flag_when(b.isNotNull() & a.isNull(), f, skip=a.isNull() & b.isNull())


@_rule("visibility_minimum_direction_missing", "minimum_visibility_direction_1", "present with a minimum")
def _vis_direction(r, f):
    pairs = [(r.num(f"minimum_visibility_{i}_m"), r.text(f"minimum_visibility_direction_{i}")) for i in (1, 2)]
    bad = S.any_of([m.isNotNull() & d.isNull() for m, d in pairs])
    return flag_when(bad, f, skip=S.all_of([m.isNull() for m, _ in pairs]))


def _cavok(r, f):
    metar, vis = r.text("metar"), r.num("prevailing_visibility_m")
    low, kinds, clear = r.p["cavok_cloud_ft"], r.p["convective"], r.p["clear_sky"]
    cloud = _some(r.layers(), lambda c: ~c.amount.isin(clear) & (c.height.isNull() | (c.height < low)))
    tower = _some(r.layers(), lambda c: c.kind.isin(kinds))
    bad = _sure(vis < r.p["cavok_visibility_m"]) | ~_none_set(r.weather()) | cloud | tower
    stated = metar.rlike(r"\bCAVOK\b")
    return F.when(metar.isNull(), "NOT_CHECKED").when(~stated, "NOT_APPLICABLE").when(bad, f).otherwise("PASS")


_rule("visibility_cavok_inconsistent", "metar", "CAVOK conditions")(_cavok)
_rule("consistency_cavok", "metar", "CAVOK conditions")(_cavok)


# --- present weather ----------------------------------------------------------------------------


@_rule("weather_invalid_code", "present_weather", "valid group")
def _weather(r, f):
    codes = r.weather()
    valid = S.weather_pattern(r.p["weather_vicinity"])
    return flag_when(_some(codes, lambda c: ~c.rlike(valid)), f, skip=_none_set(codes))


@_rule("weather_duplicate_code", "present_weather", "codes not repeated")
def _weather_twice(r, f):
    a, b, c = r.weather()
    return flag_when(_some([(a, b), (a, c), (b, c)], lambda p: p[0] == p[1]), f, skip=_none_set([a, b, c]))


@_rule("weather_visibility_inconsistent", "present_weather", "FG below 1000 m, BR 1000-5000 m")
def _weather_vis(r, f):
    codes, vis = r.weather(), r.num("prevailing_visibility_m")
    fog = _some(codes, lambda c: c.isin("FG", "FZFG"))
    mist = _some(codes, lambda c: c == "BR")
    bad = (fog & (vis >= 1000)) | (mist & ~vis.between(1000, 5000))
    return flag_when(bad, f, [vis], skip=~(fog | mist))


def _raining(codes: list[Column]) -> Column:
    return _some(codes, lambda c: c.rlike(_PRECIPITATION))


@_rule("weather_precipitation_cloud_inconsistent", "present_weather", "precipitation needs cloud")
def _weather_cloud(r, f):
    codes, clear = r.weather(), r.p["clear_sky"]
    cloudy = _some(r.layers(), lambda c: ~c.amount.isin(clear))
    return flag_when(_raining(codes) & ~cloudy, f, skip=_none_set(codes))


@_rule("weather_thunderstorm_inconsistent", "present_weather", "TS needs CB or TCU")
def _thunder(r, f):
    codes, kinds = r.weather(), r.p["convective"]
    tower = _some(r.layers(), lambda c: c.kind.isin(kinds))
    return flag_when(_some(codes, lambda c: c.contains("TS")) & ~tower, f, skip=_none_set(codes))


# --- clouds -------------------------------------------------------------------------------------


@_rule("cloud_invalid_amount", "cloud_amount", "known code")
def _amount(r, f):
    ls = r.layers()
    known = dim.codes("cloud_codes")
    return flag_when(_some(ls, lambda c: ~c.amount.isin(known)), f, skip=_none_set([c.amount for c in ls]))


@_rule("cloud_invalid_type", "cloud_type", "known code")
def _kind(r, f):
    ls = r.layers()
    known = dim.codes("cloud_types")
    return flag_when(_some(ls, lambda c: ~c.kind.isin(known)), f, skip=_none_set([c.kind for c in ls]))


@_rule("cloud_negative_height", "cloud_base_height", ">= 0")
def _height(r, f):
    ls = r.layers()
    return flag_when(_some(ls, lambda c: c.height < 0), f, skip=_none_set([c.height for c in ls]))


@_rule("cloud_amount_without_height", "cloud_base_height", "present with an amount")
def _amount_height(r, f):
    ls, exempt = r.layers(), r.p["height_exempt"]
    bad = _some(ls, lambda c: ~c.amount.isin(exempt) & c.height.isNull())
    return flag_when(bad, f, skip=_none_set([c.amount for c in ls]))


@_rule("cloud_height_without_amount", "cloud_amount", "present with a height")
def _height_amount(r, f):
    ls = r.layers()
    bad = _some(ls, lambda c: c.height.isNotNull() & c.amount.isNull())
    return flag_when(bad, f, skip=_none_set([c.height for c in ls]))


@_rule("cloud_layers_not_ordered", "cloud_base_height", "ascending")
def _ordered(r, f):
    h1, h2, h3 = (c.height for c in r.layers())
    # The third layer follows the second, or the first where the second has no height.
    bad = _sure(h2 < h1) | _sure(h3 < F.coalesce(h2, h1))
    return flag_when(bad, f, skip=_how_many([h.isNotNull() for h in (h1, h2, h3)]) < 2)


@_rule("cloud_vertical_visibility_inconsistent", "cloud_amount", "VV alone and with a height")
def _vv(r, f):
    ls = r.layers()
    vv = _some(ls, lambda c: c.amount == "VV")
    others = _how_many([c.amount.isNotNull() | c.height.isNotNull() for c in ls]) > 1
    bare = _some(ls, lambda c: (c.amount == "VV") & c.height.isNull())
    return flag_when(vv & (others | bare), f, skip=_none_set([c.amount for c in ls]))


@_rule("cloud_nsc_inconsistent", "cloud_amount", "no other layer")
def _nsc(r, f):
    ls, none = r.layers(), r.p["no_cloud"]
    several = _how_many([c.amount.isNotNull() for c in ls]) > 1
    return flag_when(_some(ls, lambda c: c.amount.isin(none)) & several, f, skip=_none_set([c.amount for c in ls]))


# --- precipitation ------------------------------------------------------------------------------

_RAIN = ("accumulated_precipitation_mm", "hourly_precipitation_mm", "daily_precipitation_mm")


@_rule("precipitation_negative", "accumulated_precipitation_mm", ">= 0")
def _negative(r, f):
    values = [r.num(c) for c in _RAIN]
    bad = S.any_of([F.coalesce(v < 0, F.lit(False)) for v in values])
    return flag_when(bad, f, skip=S.all_of([v.isNull() for v in values]))


@_rule("precipitation_period_missing", "accumulated_precipitation_mm", "period present")
def _period(r, f):
    if not r.has("precipitation_period"):
        return F.lit("NOT_CHECKED")
    return flag_when(F.col("precipitation_period").isNull(), f, [r.num("accumulated_precipitation_mm")])


@_rule("precipitation_weather_inconsistent", "accumulated_precipitation_mm", "amount and code agree")
def _rain_code(r, f):
    x = r.num("accumulated_precipitation_mm")
    return flag_when((x > r.p["precipitation_tolerance_mm"]) != _raining(r.weather()), f, [x])


# --- general consistency ------------------------------------------------------------------------


def _by_expression(rule_id: str):
    return lambda r, f: expression_flag(r.df, R.EXPRESSION_RULES[rule_id], f)


for _id, _text in R.EXPRESSION_RULES.items():
    _rule(_id, "", _text)(_by_expression(_id))


def row_rule_ids() -> list[str]:
    return list(_BUILDERS)


def reported_variable(rule_id: str) -> str:
    """The variable a rule's results are reported under; empty for rules on a whole row."""
    return _BUILDERS[rule_id][1]


def row_checks(df: DataFrame, rule_ids: list[str] | None = None, **params) -> list[Check]:
    """Checks for a frame; ``rule_ids`` that are not row-local are left to their own operators."""
    row = _Row(df, {**DEFAULTS, **params})
    wanted = [r for r in (rule_ids or [i for i in _BUILDERS if R.RULES[i].enabled]) if r in _BUILDERS]
    checks = []
    for rule_id in wanted:
        build, variable, expected = _BUILDERS[rule_id]
        observed = F.col(variable) if variable in row.have else None
        checks.append(Check(rule_id, build(row, R.RULES[rule_id].flag), variable, observed, expected))
    return checks


def null_value_checks(columns: list[str], rule_id: str = "completeness_null_value") -> list[Check]:
    """One completeness result per variable: null is MISSING."""
    flag = R.RULES[rule_id].flag
    return [Check(rule_id, flag_when(F.col(c).isNull(), flag), c, None, "present") for c in columns]


def datatype_checks(columns: dict[str, str], rule_id: str = "datatype_invalid") -> list[Check]:
    """One result per raw text column: set but not readable as its type."""
    flag = R.RULES[rule_id].flag
    out = []
    for c, dtype in columns.items():
        raw = F.col(c)
        bad = S.parse_failed(raw, S.typed_parse(raw, dtype))
        out.append(Check(rule_id, flag_when(bad, flag, skip=_blank(raw)), c, raw, dtype))
    return out


def category_flag(c: Column, domain: str, flag: str = "ERROR") -> Column:
    """Membership in a code list; a domain without codes cannot be checked."""
    allowed = dim.codes(domain)
    if not allowed:
        return F.lit("NOT_CHECKED")
    return flag_when(~c.isin(allowed), flag, [c])


def limit_flags(long_df: DataFrame, value: str = "value") -> DataFrame:
    """Four range flags of a long frame that carries phys_min, phys_max, oper_min, oper_max."""
    x = F.col(value)
    tests = {
        "range_below_physical_minimum": (x < F.col("phys_min"), "phys_min"),
        "range_above_physical_maximum": (x > F.col("phys_max"), "phys_max"),
        "range_below_operational_minimum": (x < F.col("oper_min"), "oper_min"),
        "range_above_operational_maximum": (x > F.col("oper_max"), "oper_max"),
    }
    return long_df.withColumns(
        {rule: flag_when(bad, R.RULES[rule].flag, [x, F.col(lim)]) for rule, (bad, lim) in tests.items()}
    )


def unit_flags(df: DataFrame) -> DataFrame:
    """Unit flags of a frame with unit_id/base_unit (of the value) and target_unit/target_base."""
    found, target = F.col("unit_id"), F.col("target_unit")
    return df.withColumns(
        {
            "unit_unknown": flag_when(found.isNull(), "ERROR", [F.col("unit")]),
            "unit_incompatible": flag_when(
                F.col("base_unit") != F.col("target_base"), "ERROR", [found, F.col("target_base")]
            ),
            "unit_non_canonical": flag_when(found != target, "SUSPECT", [found, target]),
        }
    )
