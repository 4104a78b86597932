"""Fixed values of the reference dimensions: stations, variables, units and code lists.

The texts below are fixed values; an installation may replace any of them with its own table
(every operator takes the dimension as a DataFrame argument).
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values. station_id|icao|fap_code|alias|aerodrome_name|site_type|operational_status|use_type|country|department|province|district|latitude|longitude|elevation_m|timezone|active
STATIONS_TEXT = """\
SPLC|SPLC||La Joya|Aeródromo de Grupo Aereo N°4 - "La Joya"|aerodrome|active|private_military|Perú|Arequipa|Islay|Mollendo|-16.7914|-71.8867|1186.0|America/Lima|true
SPRM|SPRM||San Ramon|Aerodromo de Base Aerea de San Ramon|aerodrome|active|private_military|Perú|Junin|Chanchamayo|San Ramon|-11.1283|-75.3506|835.5|America/Lima|true
SPVR|SPVR||Vitor|Aeródromo de Grupo Aereo N°2 - "Vitor"|aerodrome|active|private_military|Perú|Arequipa|Arequipa|La Joya|-16.4278|-71.8375|1560.5|America/Lima|true
SPHI|SPHI||Chiclayo|Aeropuerto Capitan FAP Jose Abelardo Quiñonez Gonzales|aerodrome|active|public|Perú|Lambayeque|Chiclayo|Chiclayo|-6.7872|-79.8281|30.0|America/Lima|true
SPID|SPID||Bergerie|Aerodromo Teniente FAP Bergerie|aerodrome|active|private_military|Perú|Loreto|Maynas|Iquitos|-3.7423|-73.2603|88.0|America/Lima|true
SPSO|SPSO||Pisco|Aeropuerto Capitán FAP Renán Elías Olivera|aerodrome|active|public|Perú|Ica|Pisco|San Andrés|-13.7448|-76.2204|12.0|America/Lima|true
SPMF|SPMF||Mazamari|Aeropuerto Mayor PNP Nancy Flores Páucar|aerodrome|active|public|Perú|Junin|Satipo|Mazamari|-11.3256|-74.5358|664.0|America/Lima|true
SPUR|SPUR||Piura|Aeropuerto Capitán FAP Guillermo Concha Iberico|aerodrome|active|public|Perú|Piura|Piura|Castilla|-5.2058|-80.6164|35.0|America/Lima|true
SPTU|SPTU||Puerto Maldonado|Aeropuerto Padre Aldamiz|aerodrome|active|public|Perú|Madre de Dios|Tambopata|Tambopata|-12.6139|-69.2286|201.0|America/Lima|true
SPTP|SPTP||El Pato|Aeródromo de Grupo Aereo N°11 - "El Pato"|aerodrome|active|private_military|Perú|Piura|Talara|Pariñas|-4.551|-81.2238|90.0|America/Lima|true
SPEV|SPEV||El Valor|Helipuerto de Estacion N°7 - El Valor|heliport|inactive|private_civil|Perú|Amazonas|Uctubamba|El Milagro|-5.6731|-78.6444|443.0|America/Lima|false
SPHR|SPHR||Pichari|Helipuerto de CE-VRAEM - "Fuerte Pichari"|heliport|active|private_military|Perú|Cusco|La Convencion|Pichari|-12.5235|-73.8306|586.0|America/Lima|true
SPLP|SPLP||Las Palmas|Base Aerea de Las Palmas - "Las Palmas"|military_base|active|private_military|Perú|Lima|Lima|Santiago de Surco|-12.1601|-76.9988|77.0|America/Lima|true
SPVS|SPVS||La Vista|Helipuerto de Estacion N°5 - La Vista|heliport|inactive|private_civil|Perú|Loreto|Datem del Marañon|Manseriche|-4.64965|-77.50579|278.0|America/Lima|false
FAQK||FAQK|Quillabamba|Helipuerto de 33° Brigada de Infantería EP|heliport|inactive|private_military|Perú|Cusco|La Convencion|Santa Ana|-12.86197|-72.70046|1052.0|America/Lima|false
SPVD|SPVD||Valle Esmeralda|Helipuerto BCT EP- N°324 - "Valle Esmeralda"|heliport|active|private_military|Perú|Junin|Satipo|Rio Tambo|-12.1266|-74.0762|565.0|America/Lima|true
SPST|SPST||Tarapoto|Aeropuerto Cadete FAP Guillermo del Castillo Paredes|aerodrome|active|public|Perú|San Martin|San Martin|Tarapoto|-6.5089|-76.3733|264.0|America/Lima|true
FANK||FANK|Cielo Punku|Helipuerto de BCT DINOES "Cielo Punku"|heliport|inactive|private_military|Perú|Cusco|La Convencion|Kimbiri|-12.8001|-73.5025|2118.0|America/Lima|false
FAMQ||FAMQ|Pampas|Helipuerto del BCT Mariscal Cáceres N°43|heliport|inactive|private_military|Perú|Huancavelica|Tayacaja|Pampas|-12.396313|-74.866113|3272.0|America/Lima|false
SPPQ|SPPQ||Alto Anapati|Helipuerto de BCT EP-N°312 - "Alto Anapati"|heliport|active|private_military|Perú|Junin|Satipo|Pangoa|-11.6727|-74.309|855.0|America/Lima|true
FAQI||FAQI|Quiteni|Helipuerto de Base de Control Fluvial MGP de Quiteni|heliport|inactive|private_military|Perú|Junin|Satipo|Rio Tambo|-11.673463|-74.014007|380.0|America/Lima|false
SPBC|SPBC||Caballococha|Aeródromo de Caballococha|aerodrome|active|public|Perú|Loreto|Mariscal Ramon Castilla|Ramon Castilla|-3.9168|-70.5082|10.0|America/Lima|true
SPEE|SPEE||El Estrecho|Aeródromo de El Estrecho|aerodrome|active|public|Perú|Loreto|Maynas|Putumayo|-2.4539|-72.6707|132.0|America/Lima|true
SPDN|SPDN||Angamos|Aeródromo de Colonia Angamos|aerodrome|active|public|Perú|Loreto|Requena|Yaquerana|-5.1372|-72.8678|130.0|America/Lima|true
SPQM|SPQM||San Lorenzo|Aeródromo de San Lorenzo|aerodrome|active|public|Perú|Loreto|Datem del Marañon|Barranca|-4.8242|-76.5603|132.0|America/Lima|true
SPCL|SPCL||Pucallpa|Aeropuerto Capitán FAP David Abensur Rengifo|aerodrome|active|public|Perú|Ucayali|Coronel Portillo|Yarinacocha|-8.3779|-74.5743|157.0|America/Lima|true
FATO||FATO|Itariato|Helipuerto BCT EP- N°333 - "Itariato"|heliport|inactive|private_military|Perú||||-12.546663|-73.138925|0.0|America/Lima|false
FASV||FASV|Soplin Vargas|Punto de Observacion - Soplin Vargas|field_observation|active||Perú|Loreto|Maynas|Teniente Manuel Clavero|-0.3734|-74.6756|198.0|America/Lima|true
FAMP||FAMP|Machu Picchu|Estacion Cientifica Antartica Machu Picchu|antarctic_base|active|private_civil|Perú|Isla Rey Jorge|Isla Rey Jorge|Isla Rey Jorge|-62.093366|-58.472822|0.0|Antarctica/King_George_Island|true
FAUM||FAUM|Union Mantaro|Helipuerto de BCT EP-N°42 - "Union Mantaro"|heliport|inactive|private_military|Perú|Ayacucho|Huanta|Llochegua|-12.285015|-74.090941|540.0|America/Lima|false
SPQU|SPQU||Arequipa|Aeropuerto Alfredo Rodriguez Ballon|aerodrome|active|public|Perú|Arequipa|Arequipa|Cerro Colorado|-16.3406|-71.5708|2560.5|America/Lima|true
FASR||FASR|Santa Rosa|Santa Rosa de Yavari|observation_site|active|private_military|Perú|Loreto|Mariscal Ramón Castilla|Yavari|-4.2425|-69.9514|70.0|America/Lima|true
FABA||FABA|Boca Anapati|Base de Control Fluvial Boca Anapati|observation_site|active|private_military|Perú|Junín|Satipo|Mazamari|-11.928|-73.9866|466.0|America/Lima|true
FAES||FAES|Esofa|Escuela de Suboficiales de la FAP|military_base|active|private_military|Perú|Lima|Lima|Santiago de Surco|-12.1546|-77.0067|64.0|America/Lima|true
"""

# Fixed values. key|canonical_name|var_group|products|unit|descriptor|role|temporal_scope|implemented|enabled
VARIABLES_TEXT = """\
station_id|station_id|identification|METAR,SPECI,TAF|||metadata|not_applicable|true|true
report_status|report_status|report_metadata|METAR,SPECI||report_types|metadata|not_applicable|true|true
report_type|report_type|report_metadata|METAR,SPECI,TAF||report_types|metadata|not_applicable|false|false
automatic_report|automatic_report|report_metadata|METAR,SPECI|||metadata|not_applicable|false|false
remarks|remarks|report_metadata|METAR,SPECI|||metadata|not_applicable|true|true
metar_report|metar|report_metadata|METAR,SPECI|||raw_report|not_applicable|true|true
year|year|datetime|METAR,SPECI,TAF|||time|instantaneous|true|true
month|month|datetime|METAR,SPECI,TAF|||time|instantaneous|true|true
day|day|datetime|METAR,SPECI,TAF|||time|instantaneous|true|true
hour_utc|hour_utc|datetime|METAR,SPECI,TAF|||time|instantaneous|true|true
minute|minute|datetime|METAR,SPECI,TAF|||time|instantaneous|true|true
datetime_utc|datetime_utc|datetime|METAR,SPECI,TAF|||time|instantaneous|true|true
issue_time|issue_time_utc|taf_validity|TAF|||forecast_time|instantaneous|false|false
validity_start|validity_start_utc|taf_validity|TAF|||forecast_time|period_start|false|false
validity_end|validity_end_utc|taf_validity|TAF|||forecast_time|period_end|false|false
wind_direction|wind_direction_deg|surface_wind|METAR,SPECI,TAF|degree|wind_codes|observed|instantaneous|true|true
wind_direction_variation_ccw|wind_direction_ccw_deg|surface_wind|METAR,SPECI|degree||observed|instantaneous|true|true
wind_direction_variation_cw|wind_direction_cw_deg|surface_wind|METAR,SPECI|degree||observed|instantaneous|true|true
wind_speed|wind_speed_kt|surface_wind|METAR,SPECI,TAF|knot||observed|instantaneous|true|true
wind_gust|wind_gust_kt|surface_wind|METAR,SPECI,TAF|knot||observed|instantaneous|true|true
wind_variable|wind_variable|surface_wind|METAR,SPECI,TAF||wind_codes|observed|instantaneous|false|false
low_level_wind_shear|low_level_wind_shear|supplementary_information|METAR,SPECI,TAF||wind_shear_codes|observed|instantaneous|false|false
air_temperature|air_temperature_c|temperature|METAR,SPECI|celsius||observed|instantaneous|true|true
wet_bulb_temperature|wet_bulb_temperature_c|temperature|LOCAL_OBSERVATION|celsius||observed|instantaneous|true|true
dew_point_temperature|dew_point_temperature_c|temperature|METAR,SPECI|celsius||observed|instantaneous|true|true
maximum_daily_temperature|maximum_temperature_c|temperature|LOCAL_OBSERVATION,CLIMATOLOGY|celsius||observed|daily_extreme|true|true
minimum_daily_temperature|minimum_temperature_c|temperature|LOCAL_OBSERVATION,CLIMATOLOGY|celsius||observed|daily_extreme|true|true
relative_humidity|relative_humidity_pct|humidity|LOCAL_OBSERVATION,CLIMATOLOGY|percent||observed|instantaneous|true|true
hourly_precipitation|accumulated_precipitation_mm|precipitation|LOCAL_OBSERVATION,CLIMATOLOGY|millimeter||observed|hourly_accumulation|true|true
daily_precipitation|daily_precipitation_mm|precipitation|CLIMATOLOGY|millimeter||observed|daily_accumulation|false|false
qnh|qnh_hpa|pressure|METAR,SPECI|hPa||observed|instantaneous|true|true
qfe|qfe_hpa|pressure|LOCAL_OBSERVATION|hPa||observed|instantaneous|true|true
prevailing_visibility|prevailing_visibility_m|visibility|METAR,SPECI,TAF|meter|visibility_codes|observed|instantaneous|true|true
minimum_visibility_1|minimum_visibility_1_m|visibility|METAR,SPECI|meter||observed|instantaneous|true|true
minimum_visibility_direction_1|minimum_visibility_direction_1|visibility|METAR,SPECI||visibility_codes|observed|instantaneous|true|true
minimum_visibility_2|minimum_visibility_2_m|visibility|METAR,SPECI|meter||observed|instantaneous|true|true
minimum_visibility_direction_2|minimum_visibility_direction_2|visibility|METAR,SPECI||visibility_codes|observed|instantaneous|true|true
runway_visual_range|runway_visual_range_m|runway_visual_range|METAR,SPECI|meter||observed|instantaneous|false|false
rvr_tendency|rvr_tendency|runway_visual_range|METAR,SPECI||rvr_tendency_codes|observed|instantaneous|false|false
cavok|cavok|visibility|METAR,SPECI,TAF|||observed|instantaneous|false|false
present_weather_1|present_weather_1|weather|METAR,SPECI||weather_codes|observed|instantaneous|true|true
present_weather_2|present_weather_2|weather|METAR,SPECI||weather_codes|observed|instantaneous|true|true
present_weather_3|present_weather_3|weather|METAR,SPECI||weather_codes|observed|instantaneous|true|true
recent_weather|recent_weather|supplementary_information|METAR,SPECI||weather_codes|observed|instantaneous|false|false
forecast_weather|forecast_weather|taf_forecast|TAF||weather_codes|forecast|instantaneous|false|false
cloud_amount_1|cloud_amount_1|cloud_layer_1|METAR,SPECI,TAF||cloud_codes|observed|instantaneous|true|true
cloud_base_height_1|cloud_base_height_1_ft|cloud_layer_1|METAR,SPECI,TAF|foot||observed|instantaneous|true|true
cloud_type_1|cloud_type_1|cloud_layer_1|METAR,SPECI,TAF||cloud_types|observed|instantaneous|true|true
cloud_amount_2|cloud_amount_2|cloud_layer_2|METAR,SPECI,TAF||cloud_codes|observed|instantaneous|true|true
cloud_base_height_2|cloud_base_height_2_ft|cloud_layer_2|METAR,SPECI,TAF|foot||observed|instantaneous|true|true
cloud_type_2|cloud_type_2|cloud_layer_2|METAR,SPECI,TAF||cloud_types|observed|instantaneous|true|true
cloud_amount_3|cloud_amount_3|cloud_layer_3|METAR,SPECI,TAF||cloud_codes|observed|instantaneous|true|true
cloud_base_height_3|cloud_base_height_3_ft|cloud_layer_3|METAR,SPECI,TAF|foot||observed|instantaneous|true|true
cloud_type_3|cloud_type_3|cloud_layer_3|METAR,SPECI,TAF||cloud_types|observed|instantaneous|true|true
vertical_visibility|vertical_visibility_ft|clouds|METAR,SPECI,TAF|foot||observed|instantaneous|false|false
forecast_wind_direction|forecast_wind_direction_deg|taf_forecast|TAF|degree|wind_codes|forecast|instantaneous|false|false
forecast_wind_speed|forecast_wind_speed_kt|taf_forecast|TAF|knot||forecast|instantaneous|false|false
forecast_wind_gust|forecast_wind_gust_kt|taf_forecast|TAF|knot||forecast|instantaneous|false|false
forecast_visibility|forecast_visibility_m|taf_forecast|TAF|meter|visibility_codes|forecast|instantaneous|false|false
forecast_cloud_amount|forecast_cloud_amount|taf_forecast|TAF||cloud_codes|forecast|instantaneous|false|false
forecast_cloud_base_height|forecast_cloud_base_height_ft|taf_forecast|TAF|foot||forecast|instantaneous|false|false
forecast_cloud_type|forecast_cloud_type|taf_forecast|TAF||cloud_types|forecast|instantaneous|false|false
forecast_vertical_visibility|forecast_vertical_visibility_ft|taf_forecast|TAF|foot||forecast|instantaneous|false|false
forecast_cavok|forecast_cavok|taf_forecast|TAF|||forecast|instantaneous|false|false
maximum_forecast_temperature|maximum_forecast_temperature_c|taf_temperature|TAF|celsius||forecast|forecast_extreme|false|false
maximum_temperature_time|maximum_temperature_time_utc|taf_temperature|TAF|||forecast_time|instantaneous|false|false
minimum_forecast_temperature|minimum_forecast_temperature_c|taf_temperature|TAF|celsius||forecast|forecast_extreme|false|false
minimum_temperature_time|minimum_temperature_time_utc|taf_temperature|TAF|||forecast_time|instantaneous|false|false
change_indicator|change_indicator|taf_change_groups|TAF,TREND||trend_codes|forecast|instantaneous|false|false
change_period_start|change_period_start_utc|taf_change_groups|TAF,TREND|||forecast_time|period_start|false|false
change_period_end|change_period_end_utc|taf_change_groups|TAF,TREND|||forecast_time|period_end|false|false
forecast_probability|forecast_probability_pct|taf_change_groups|TAF|percent|probability_codes|forecast|instantaneous|false|false
sea_surface_temperature|sea_surface_temperature_c|supplementary_information|METAR,SPECI|celsius||observed|instantaneous|false|false
sea_state|sea_state|supplementary_information|METAR,SPECI||sea_state_codes|observed|instantaneous|false|false
runway_state|runway_state|runway_state|METAR,SPECI||runway_state_codes|observed|instantaneous|false|false
"""

# Fixed values. unit_id|symbol|quantity|base_unit|factor|offset|precision|short token|aliases separated by ';'
UNITS_TEXT = """\
temperature_celsius|°C|temperature|temperature_kelvin|1.0|273.15|1|celsius|C;degC;degree_celsius;degrees_celsius
temperature_kelvin|K|temperature|temperature_kelvin|1.0|0.0|2|kelvin|K
pressure_hectopascal|hPa|pressure|pressure_pascal|100.0|0.0|1|hPa|HPA;hectopascal;mb;mbar
pressure_pascal|Pa|pressure|pressure_pascal|1.0|0.0|0|pascal|PA;pascal
speed_knot|kt|speed|speed_meter_per_second|0.5144444444|0.0|1|knot|KT;KTS;knot;knots
speed_meter_per_second|m/s|speed|speed_meter_per_second|1.0|0.0|1|meter_per_second|mps;ms-1;m s-1
speed_kilometer_per_hour|km/h|speed|speed_meter_per_second|0.2777777778|0.0|1|kilometer_per_hour|kmh;kph;km h-1
length_meter|m|length|length_meter|1.0|0.0|0|meter|metre;meters;metres
length_kilometer|km|length|length_meter|1000.0|0.0|1|kilometer|kilometre;kilometers;kilometres
length_foot|ft|length|length_meter|0.3048|0.0|0|foot|FT;feet;foot
angle_degree|°|plane_angle|angle_degree|1.0|0.0|0|degree|deg;degrees
ratio_percent|%|dimensionless_ratio|ratio_fraction|0.01|0.0|1|percent|pct;percentage
ratio_fraction|1|dimensionless_ratio|ratio_fraction|1.0|0.0|4|fraction|dimensionless;unitless
precipitation_millimeter|mm|precipitation_depth|length_meter|0.001|0.0|1|millimeter|millimetre;millimeters;millimetres
time_second|s|time|time_second|1.0|0.0|0|second|sec;seconds
time_minute|min|time|time_second|60.0|0.0|0|minute|minutes
time_hour|h|time|time_second|3600.0|0.0|0|hour|hr;hours
time_day|d|time|time_second|86400.0|0.0|0|day|days
"""

# Code lists of the descriptors, domain: codes separated by a blank.
CODE_LISTS = {
    "report_types": "METAR SPECI TAF LOCAL_OBSERVATION HISTORICAL_OBSERVATION",
    "cloud_codes": "SKC CLR FEW SCT BKN OVC NSC NCD VV",
    "cloud_types": "CB TCU",
    "weather_precipitation": "DZ RA SN SG IC PL GR GS UP",
    "weather_obscuration": "FG BR HZ FU DU SA VA",
    "weather_other": "PO SQ FC SS DS",
    "weather_descriptors": "MI BC PR DR BL SH TS FZ",
    "weather_intensity": "- +",
    "visibility_codes": "CAVOK NDV",
    "wind_codes": "VRB CALM",
    "trend_codes": "NOSIG TEMPO BECMG",
}

# Descriptions of the sky, weather, report, visibility, wind and trend codes.
CODE_DESCRIPTIONS = {
    "cloud_codes": {
        "SKC": "Sky Clear", "CLR": "Clear", "FEW": "Few Clouds", "SCT": "Scattered Clouds",
        "BKN": "Broken Clouds", "OVC": "Overcast", "NSC": "No Significant Clouds",
        "NCD": "No Cloud Detected", "VV": "Vertical Visibility",
    },
    "cloud_types": {"CB": "Cumulonimbus", "TCU": "Towering Cumulus"},
    "weather_precipitation": {
        "DZ": "Drizzle", "RA": "Rain", "SN": "Snow", "SG": "Snow Grains", "IC": "Ice Crystals",
        "PL": "Ice Pellets", "GR": "Hail", "GS": "Small Hail", "UP": "Unknown Precipitation",
    },
    "weather_obscuration": {
        "FG": "Fog", "BR": "Mist", "HZ": "Haze", "FU": "Smoke", "DU": "Dust", "SA": "Sand", "VA": "Volcanic Ash",
    },
    "weather_other": {
        "PO": "Dust Devils", "SQ": "Squall", "FC": "Funnel Cloud", "SS": "Sandstorm", "DS": "Duststorm",
    },
    "weather_descriptors": {
        "MI": "Shallow", "BC": "Patches", "PR": "Partial", "DR": "Low Drifting", "BL": "Blowing",
        "SH": "Showers", "TS": "Thunderstorm", "FZ": "Freezing",
    },
    "weather_intensity": {"-": "Light", "": "Moderate", "+": "Heavy"},
    "report_types": {"METAR": "Routine Aviation Weather Report", "SPECI": "Special Aviation Weather Report"},
    "visibility_codes": {"CAVOK": "Ceiling And Visibility OK", "NDV": "No Directional Variation"},
    "wind_codes": {"VRB": "Variable Wind", "CALM": "Calm Wind"},
    "trend_codes": {"NOSIG": "No Significant Change", "TEMPO": "Temporary Fluctuation", "BECMG": "Becoming"},
}

# Oktas behind a cloud amount code.
CLOUD_OKTAS = {"SKC": "0", "CLR": "0", "FEW": "1-2", "SCT": "3-4", "BKN": "5-7", "OVC": "8"}

# Tokens that mean "no value".
MISSING_NUMERIC = [-999.0, -9999.0, 9999.0, 99999.0]
MISSING_TEXT = ["", " ", "-", "--", "---", "NA", "N/A", "NULL", "NONE", "NaN", "nan"]

# Finding categories and the numeric severity scale.
QUALITY_CATEGORIES = {
    "OK": "Observation accepted", "CORRECTED": "Automatically corrected", "MISSING": "Missing value",
    "DUPLICATE": "Duplicate observation", "OUT_OF_RANGE": "Physical range exceeded",
    "TEMPORAL": "Temporal inconsistency", "CONSISTENCY": "Physical inconsistency",
    "CLIMATOLOGY": "Climatological anomaly", "STATISTICAL": "Statistical anomaly",
    "METADATA": "Metadata inconsistency",
}
SEVERITY_SCALE = {"INFO": 1, "LOW": 2, "MEDIUM": 3, "HIGH": 4, "CRITICAL": 5}


def codes(domain: str) -> list[str]:
    return CODE_LISTS.get(domain, "").split()


def _rows(text: str) -> list[list[str | None]]:
    return [[c if c != "" else None for c in line.split("|")] for line in text.strip("\n").split("\n")]


def stations(spark: SparkSession, timezone_overrides: dict[str, str] | None = None) -> DataFrame:
    """Station dimension. A zone the IANA database does not know becomes null (``convert_timezone``
    would fail the job on it), unless ``timezone_overrides`` names a replacement."""
    known = available_timezones()
    fix = timezone_overrides or {}
    rows = []
    for r in _rows(STATIONS_TEXT):
        zone = fix.get(r[15], r[15])
        rows.append(
            (*r[:12], float(r[12]), float(r[13]), float(r[14]), zone if zone in known else None, r[16] == "true")
        )
    return spark.createDataFrame(
        rows,
        "station_id string, icao string, fap_code string, alias string, aerodrome_name string, site_type string,"
        " operational_status string, use_type string, country string, department string, province string,"
        " district string, latitude double, longitude double, elevation_m double, timezone string, active boolean",
    )


def variables(spark: SparkSession) -> DataFrame:
    rows = [
        (r[0], r[1], r[2], r[3].split(","), r[4], r[5], r[6], r[7], r[8] == "true", r[9] == "true")
        for r in _rows(VARIABLES_TEXT)
    ]
    return spark.createDataFrame(
        rows,
        "key string, canonical_name string, var_group string, products array<string>, unit string,"
        " descriptor string, role string, temporal_scope string, implemented boolean, enabled boolean",
    )


def select_variables(
    variables_df: DataFrame,
    enabled: bool | None = None,
    implemented: bool | None = None,
    product: str | None = None,
    role: str | None = None,
) -> DataFrame:
    """Catalogue subset by attribute; the result drives which columns are melted or checked."""
    out = variables_df
    if enabled is not None:
        out = out.filter(F.col("enabled") == enabled)
    if implemented is not None:
        out = out.filter(F.col("implemented") == implemented)
    if product is not None:
        out = out.filter(F.array_contains("products", product))
    if role is not None:
        out = out.filter(F.col("role") == role)
    return out


def units(spark: SparkSession) -> DataFrame:
    rows = [(r[0], r[1], r[2], r[3], float(r[4]), float(r[5]), int(r[6]), r[7]) for r in _rows(UNITS_TEXT)]
    return spark.createDataFrame(
        rows,
        "unit_id string, symbol string, quantity string, base_unit string, factor double, offset double,"
        " precision int, token string",
    )


def unit_aliases(spark: SparkSession) -> DataFrame:
    """Every accepted spelling (identifier, symbol, short token, alias) of a unit, one row each."""
    rows = []
    for r in _rows(UNITS_TEXT):
        names = dict.fromkeys([r[0], r[1], r[7], *r[8].split(";")])
        rows.extend((name, r[0]) for name in names)
    return spark.createDataFrame(rows, "alias string, unit_id string")


def descriptors(spark: SparkSession) -> DataFrame:
    rows = [(d, c, text) for d, m in CODE_DESCRIPTIONS.items() for c, text in m.items()]
    return spark.createDataFrame(rows, "domain string, code string, description string")


def missing_tokens(spark: SparkSession) -> DataFrame:
    rows = [("numeric", str(v)) for v in MISSING_NUMERIC] + [("text", t) for t in MISSING_TEXT]
    return spark.createDataFrame(rows, "kind string, token string")
