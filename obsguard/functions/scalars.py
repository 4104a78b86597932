"""Column functions: text cleaning, parsing, units, angles, time and small lookups.

Everything here is a plain column expression, so it stays inside code generation. The one
exception is :func:`nfkc` (Unicode compatibility folding has no built-in); callers apply it to
header rows only.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsguard.catalogs import dimensions as dim

NBSP = " "
EARTH_RADIUS_KM = 6371.0088
_EPOCH = "1970-01-01 00:00:00"


# --- text ---------------------------------------------------------------------------------------


def squeeze(c: Column) -> Column:
    """Trim and collapse runs of (Unicode) white space to one blank."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


#: The characters with Unicode's white-space property.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def blank_to_null(c: Column) -> Column:
    """Null for a text of white space only; one that begins with a visible ASCII character needs no trimming."""
    return F.when(F.ascii(c).between(33, 126), c).when(F.btrim(c, F.lit(WHITE_SPACE)) != "", c)


def nfkc_array(texts: Column) -> Column:
    """Unicode compatibility folding of an array of texts."""

    # Defined inside so that it travels with the plan; workers need not have this package.
    def fold(s: pd.Series) -> pd.Series:
        return s.map(
            lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFKC", x) for x in xs]
        )

    return F.pandas_udf(fold, T.ArrayType(T.StringType()))(texts)


def nfkc(text: Column) -> Column:
    return nfkc_array(F.array(text))[0]


def normalize_header(folded: Column) -> Column:
    """Header text for comparison; ``folded`` has been through :func:`nfkc`."""
    return F.coalesce(squeeze(F.replace(folded, F.lit(NBSP), F.lit(" "))), F.lit(""))


def upper_fields(df, fields: list[str]):
    return df.withColumns({f: F.upper(F.col(f)) for f in fields if f in df.columns})


def decimal_point(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def parse_double(c: Column) -> Column:
    return decimal_point(F.trim(c)).try_cast("double")


def missing_text_to_null(c: Column, tokens: list[str] | None = None) -> Column:
    tokens = sorted({t.strip() for t in (dim.MISSING_TEXT if tokens is None else tokens)})
    return F.when(~F.trim(c).isin(tokens), c)


def missing_number_to_null(c: Column, sentinels: list[float] | None = None) -> Column:
    return F.when(~c.isin(dim.MISSING_NUMERIC if sentinels is None else sentinels), c)


# 9999 m is also the normal "10 km or more" report, so visibilities keep it.
MISSING_EXEMPT = ("prevailing_visibility_m", "minimum_visibility_1_m", "minimum_visibility_2_m")


def format_size(size_bytes: Column) -> Column:
    """Human-readable size, base 1024, two decimals."""
    size = size_bytes.cast("double")
    out = F.concat(F.format_number(size / 1024.0**4, 2), F.lit(" TB"))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(
            size < 1024.0 ** (power + 1), F.concat(F.format_number(size / 1024.0**power, 2), F.lit(f" {unit}"))
        ).otherwise(out)
    return out


def column_letter(position: Column) -> Column:
    """Spreadsheet letter(s) of a 1-based column number (1..18278)."""
    n = position.cast("int") - 1

    def letter(x: Column) -> Column:
        return F.char(F.lit(65) + x)

    two = F.floor(n / 26).cast("int") - 1
    three = F.floor((n - 26) / 676).cast("int") - 1
    return (
        F.when(n < 26, letter(n))
        .when(n < 702, F.concat(letter(two), letter(n % 26)))
        .otherwise(F.concat(letter(three), letter(F.floor((n - 702) % 676 / 26).cast("int")), letter((n - 702) % 26)))
    )


def weather_pattern(allow_vicinity: bool = False) -> str:
    """Anchored pattern of one weather group, built from the code lists."""
    phenomena = "|".join(
        dim.codes("weather_precipitation") + dim.codes("weather_obscuration") + dim.codes("weather_other")
    )
    descriptors = "|".join(dim.codes("weather_descriptors"))
    prefix = "[+-]|VC" if allow_vicinity else "[+-]"
    return f"^({prefix})?(({descriptors})({phenomena})*|({phenomena})+)$"


def weather_code_valid(c: Column, allow_vicinity: bool = False) -> Column:
    return c.rlike(weather_pattern(allow_vicinity))


# --- numbers ------------------------------------------------------------------------------------


def convert_unit(x: Column, factor: Column, offset: Column, to_factor: Column, to_offset: Column) -> Column:
    """Through the base unit; the caller rounds to the target's precision."""
    return (x * factor + offset - to_offset) / to_factor


def round_to(x: Column, digits: Column) -> Column:
    """HALF_UP rounding to a per-row number of decimals; from nine on, and without one, the value stays."""
    out = x
    for d in range(9):
        out = F.when(digits == d, round_half_up(x, d)).otherwise(out)
    return out


def round_half_up(x: Column, digits: int) -> Column:
    """Decimal HALF_UP: binary noise beyond nine decimals is cleared first, so 6.65 / 1 rounds to 6.7."""
    return F.round(F.round(x, 9), digits)


def wrap_angle(x: Column) -> Column:
    return F.pmod(x, F.lit(360.0))


def angle_difference(a: Column, b: Column) -> Column:
    return F.least(F.pmod(a - b, F.lit(360.0)), F.pmod(b - a, F.lit(360.0)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def vapour_pressure(t: Column) -> Column:
    """Magnus formula, hPa over water."""
    return F.exp(t * 17.62 / (t + 243.12)) * 6.112


def relative_humidity(t: Column, td: Column) -> Column:
    return vapour_pressure(td) / vapour_pressure(t) * 100.0


def typed_parse(raw: Column, dtype: str) -> Column:
    """Parse to integer / number / boolean / string; unparsable text becomes null."""
    text = F.trim(raw)
    if dtype == "integer":
        number = decimal_point(text).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    if dtype == "number":
        return decimal_point(text).try_cast("double")
    if dtype == "boolean":
        return text.try_cast("boolean")
    return text


def parse_failed(raw: Column, parsed: Column) -> Column:
    return raw.isNotNull() & (F.trim(raw) != "") & parsed.isNull()


# --- time ---------------------------------------------------------------------------------------


def datetime_from_parts(y: Column, mo: Column, d: Column, h: Column, mi: Column) -> Column:
    """UTC time from its components; an impossible date becomes null."""
    return F.try_make_timestamp_ntz(
        y.cast("int"), mo.cast("int"), d.cast("int"), h.cast("int"), mi.cast("int"), F.lit(0).cast("decimal(8,6)")
    )


def climatological_year(ts: Column, start_month: int = 1) -> Column:
    """Calendar year by default; with a later start month, months before it belong to the year before."""
    return (F.year(ts) - (F.month(ts) < start_month).cast("int")).cast("short")


def local_time(ts: Column, zone: Column) -> Column:
    """UTC wall time to station wall time; a null zone gives null."""
    return F.convert_timezone(F.lit("UTC"), zone, ts.cast("timestamp_ntz"))


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 of a wall time, whatever the session zone is."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def hours_between(later: Column, earlier: Column) -> Column:
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(3.6e9)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


# --- arrays and lookups -------------------------------------------------------------------------


def cloud_layers(n: int = 3) -> Column:
    return F.array(
        *[
            F.struct(
                F.col(f"cloud_amount_{i}").alias("amount"),
                F.col(f"cloud_base_height_{i}_ft").cast("double").alias("height"),
                F.col(f"cloud_type_{i}").alias("kind"),
            )
            for i in range(1, n + 1)
        ]
    )


def weather_codes(n: int = 3) -> Column:
    return F.array_compact(F.array(*[F.col(f"present_weather_{i}") for i in range(1, n + 1)]))


def describe_code(c: Column, domain: str) -> Column:
    table = dim.CODE_DESCRIPTIONS[domain]
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.element_at(F.create_map(*pairs), c)


def cloud_oktas(c: Column) -> Column:
    pairs = [F.lit(x) for kv in dim.CLOUD_OKTAS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), c)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
