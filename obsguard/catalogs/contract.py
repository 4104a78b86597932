"""Fixed values of the observation contract: the 52 positioned input columns and the 67 output columns.

The texts below are fixed values: they must equal the published contract for results to match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values. position|header|standard name|input type|nullable|header aliases separated by ';'
INPUT_COLUMNS_TEXT = """\
1|Identificador OACI o Cod FAP|station_id|string|no|Identificador OACI;Código OACI;Codigo OACI;Cod OACI;Código FAP;Codigo FAP;Cod FAP;OACI;ICAO
2|Estado del producto de aviación (rutinario, especial, corregido, no disponible)|report_status|string|no|Estado del producto;Estado producto;Estado del reporte;Tipo de reporte
3|Año|year|integer|no|Ano;AÑO;YEAR;Year
4|Mes|month|integer|no|MES;Month
5|Dia|day|integer|no|Día;DIA;Day
6|Hora (UTC)|hour_utc|integer|no|Hora UTC;Hora;Hour UTC
7|Minuto|minute|integer|no|MINUTO;Minute
8|Dirección del viento|wind_direction_deg|number|yes|Direccion del viento;Dirección viento;Direccion viento
9|Dirección extrema antihoraria del viento|wind_direction_ccw_deg|number|yes|Direccion extrema antihoraria del viento;Dirección mínima del viento;Direccion minima del viento
10|Dirección extrema horaria del viento|wind_direction_cw_deg|number|yes|Direccion extrema horaria del viento;Dirección máxima del viento;Direccion maxima del viento
11|Velocidad del viento (nudos)|wind_speed_kt|number|yes|Velocidad del viento;Velocidad viento (nudos);Velocidad del viento (kt);Velocidad viento
12|Velocidad del viento. Rafagas (nudos)|wind_gust_kt|number|yes|Velocidad del viento. Ráfagas (nudos);Velocidad del viento Rafagas (nudos);Velocidad del viento Ráfagas (nudos);Rafagas (nudos);Ráfagas (nudos);Racha (nudos)
13|Temperatura del aire|air_temperature_c|number|yes|Temperatura aire;Temperatura;Temperatura del Aire
14|Temperatura Bulbo humedo|wet_bulb_temperature_c|number|yes|Temperatura Bulbo humedo;Temperatura Bulbo húmedo;Temperatura de bulbo humedo;Temperatura de bulbo húmedo
15|Temperatura de rocio|dew_point_temperature_c|number|yes|Temperatura de rocio;Temperatura de rocío;Punto de rocio;Punto de rocío
16|Presion a nivel medio del mar (QNH)|qnh_hpa|number|yes|Presión a nivel medio del mar (QNH);Presion a nivel del mar (QNH);Presión a nivel del mar (QNH);QNH
17|Presion a nivel de la estacion (QFE)|qfe_hpa|number|yes|Presión a nivel de la estación (QFE);Presion a nivel de la estación (QFE);Presión a nivel de la estacion (QFE);QFE
18|Visibilidad reinante|prevailing_visibility_m|number|yes|Visibilidad predominante;Visibilidad Reinante
19|1° Visibilidad minima horizontal|minimum_visibility_1_m|number|yes|1° Visibilidad mínima horizontal;1 Visibilidad minima horizontal;Primera visibilidad minima horizontal;Primera visibilidad mínima horizontal
20|1° Direccion de la visibilidad horizontal minima observada|minimum_visibility_direction_1|string|yes|1° Dirección de la visibilidad horizontal mínima observada;1° Direccion de visibilidad minima;1° Dirección de visibilidad mínima
21|2° Visibilidad minima horizontal|minimum_visibility_2_m|number|yes|2° Visibilidad mínima horizontal;2 Visibilidad minima horizontal;Segunda visibilidad minima horizontal;Segunda visibilidad mínima horizontal
22|2° Direccion de la visibilidad horizontal minima observada|minimum_visibility_direction_2|string|yes|2° Dirección de la visibilidad horizontal mínima observada;2° Direccion de visibilidad minima;2° Dirección de visibilidad mínima
23|1 Tiempo presente significativo|present_weather_1|string|yes|1° Tiempo presente significativo;Tiempo presente significativo 1;Primer tiempo presente significativo
24|2 Tiempo presente significativo|present_weather_2|string|yes|2° Tiempo presente significativo;Tiempo presente significativo 2;Segundo tiempo presente significativo
25|3 Tiempo presente significativo|present_weather_3|string|yes|3° Tiempo presente significativo;Tiempo presente significativo 3;Tercer tiempo presente significativo
26|1° Cantidad de nubes|cloud_amount_1|string|yes|1°  Cantidad de nubes;1 Cantidad de nubes;Cantidad de nubes 1;Primera cantidad de nubes
27|1° Altura de la base de la nube (pies)|cloud_base_height_1_ft|number|yes|1 Altura de la base de la nube (pies);Altura de la base de la nube 1 (pies);Primera altura de la base de la nube (pies)
28|1° Tipo de nube|cloud_type_1|string|yes|1 Tipo de nube;Tipo de nube 1;Primer tipo de nube
29|2° Cantidad de nubes|cloud_amount_2|string|yes|2°  Cantidad de nubes;2 Cantidad de nubes;Cantidad de nubes 2;Segunda cantidad de nubes
30|2° Altura de la base de la nube (pies)|cloud_base_height_2_ft|number|yes|2 Altura de la base de la nube (pies);Altura de la base de la nube 2 (pies);Segunda altura de la base de la nube (pies)
31|2° Tipo de nube|cloud_type_2|string|yes|2 Tipo de nube;Tipo de nube 2;Segundo tipo de nube
32|3° Cantidad de nubes|cloud_amount_3|string|yes|3°  Cantidad de nubes;3 Cantidad de nubes;Cantidad de nubes 3;Tercera cantidad de nubes
33|3° Altura de la base de la nube (pies)|cloud_base_height_3_ft|number|yes|3 Altura de la base de la nube (pies);Altura de la base de la nube 3 (pies);Tercera altura de la base de la nube (pies)
34|3° Tipo de nube|cloud_type_3|string|yes|3 Tipo de nube;Tipo de nube 3;Tercer tipo de nube
35|Temperatura Maxima|maximum_temperature_c|number|yes|Temperatura Máxima;Temperatura maxima;Temperatura máxima
36|Temperatura Minima|minimum_temperature_c|number|yes|Temperatura Mínima;Temperatura minima;Temperatura mínima
37|Precipitacion Acumulada|accumulated_precipitation_mm|number|yes|Precipitación Acumulada;Precipitacion acumulada;Precipitación acumulada
38|Humedad relativa (%)|relative_humidity_pct|number|yes|Humedad Relativa (%);Humedad relativa;Humedad Relativa
39|Pais|country|string|yes|País;PAIS;Country
40|Departamento|department|string|yes|DEPARTAMENTO;Region;Región
41|Provincia|province|string|yes|PROVINCIA;Province
42|Distrito|district|string|yes|DISTRITO;District
43|Latitud|latitude|number|yes|LATITUD;Latitude
44|Longitud|longitude|number|yes|LONGITUD;Longitude
45|Elevacion|elevation_m|number|yes|Elevación;Altitud;Elevation
46|Lugar|location|string|yes|Localidad;Ubicación;Ubicacion;Location
47|Nombre del Aeródromo|aerodrome_name|string|yes|Nombre del Aerodromo;Aeródromo;Aerodromo;Nombre de Aeródromo;Nombre de Aerodromo
48|Tipo de Estacion|station_type|string|yes|Tipo de Estación;Tipo Estacion;Tipo Estación
49|Remarks|remarks|string|yes|Observaciones;Comentarios;Remark
50|Reporte METAR|metar|string|yes|METAR;Reporte;METAR Report
51|Oficina Meteorologica|meteorological_office|string|yes|Oficina Meteorológica;Oficina meteorologica;Oficina meteorológica
52|Observador|observer|string|yes|Observer;Nombre del observador
"""

# Fixed values. position|name|type|nullable|group
CANONICAL_COLUMNS_TEXT = """\
1|record_id|string|no|technical
2|station_id|string|no|identification
3|datetime_utc|timestamp|no|datetime
4|date|date|no|datetime
5|year|short|no|datetime
6|month|byte|no|datetime
7|day|byte|no|datetime
8|hour_utc|byte|no|datetime
9|minute|byte|no|datetime
10|climatological_year|short|no|datetime
11|report_status|string|no|report
12|wind_direction_deg|float|yes|wind
13|wind_direction_ccw_deg|float|yes|wind
14|wind_direction_cw_deg|float|yes|wind
15|wind_speed_kt|float|yes|wind
16|wind_gust_kt|float|yes|wind
17|air_temperature_c|float|yes|temperature
18|wet_bulb_temperature_c|float|yes|temperature
19|dew_point_temperature_c|float|yes|temperature
20|maximum_temperature_c|float|yes|temperature
21|minimum_temperature_c|float|yes|temperature
22|qnh_hpa|float|yes|pressure
23|qfe_hpa|float|yes|pressure
24|relative_humidity_pct|float|yes|humidity
25|accumulated_precipitation_mm|float|yes|precipitation
26|prevailing_visibility_m|float|yes|visibility
27|minimum_visibility_1_m|float|yes|visibility
28|minimum_visibility_direction_1|string|yes|visibility
29|minimum_visibility_2_m|float|yes|visibility
30|minimum_visibility_direction_2|string|yes|visibility
31|present_weather_1|string|yes|weather
32|present_weather_2|string|yes|weather
33|present_weather_3|string|yes|weather
34|cloud_amount_1|string|yes|cloud_layer_1
35|cloud_base_height_1_ft|float|yes|cloud_layer_1
36|cloud_type_1|string|yes|cloud_layer_1
37|cloud_amount_2|string|yes|cloud_layer_2
38|cloud_base_height_2_ft|float|yes|cloud_layer_2
39|cloud_type_2|string|yes|cloud_layer_2
40|cloud_amount_3|string|yes|cloud_layer_3
41|cloud_base_height_3_ft|float|yes|cloud_layer_3
42|cloud_type_3|string|yes|cloud_layer_3
43|country|string|yes|station_metadata
44|department|string|yes|station_metadata
45|province|string|yes|station_metadata
46|district|string|yes|station_metadata
47|latitude|double|no|station_metadata
48|longitude|double|no|station_metadata
49|elevation_m|float|yes|station_metadata
50|location|string|yes|station_metadata
51|aerodrome_name|string|no|station_metadata
52|station_type|string|no|station_metadata
53|meteorological_office|string|yes|station_metadata
54|observer|string|yes|station_metadata
55|remarks|string|yes|report
56|metar|string|yes|report
57|source_file|string|no|provenance
58|source_sheet|string|yes|provenance
59|source_row|int|yes|provenance
60|source_hash|string|yes|provenance
61|pipeline_run_id|string|no|technical
62|processing_timestamp|timestamp|no|technical
63|pipeline_version|string|no|technical
64|dictionary_version|string|no|technical
65|qc_status|string|no|quality_control
66|qc_flags|array<string>|yes|quality_control
67|qc_score|float|yes|quality_control
"""

_SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "array<string>": T.ArrayType(T.StringType()),
}

# 52 expected columns plus a margin that lets stray columns be seen and reported.
READ_BUFFER_COLUMNS = 8


def _rows(text: str) -> list[list[str]]:
    return [line.split("|") for line in text.strip("\n").split("\n")]


def input_headers() -> list[str]:
    return [r[1] for r in _rows(INPUT_COLUMNS_TEXT)]


def header_to_standard() -> dict[str, str]:
    return {r[1]: r[2] for r in _rows(INPUT_COLUMNS_TEXT)}


def header_aliases() -> dict[str, str]:
    """Alias header -> contract header."""
    return {a: r[1] for r in _rows(INPUT_COLUMNS_TEXT) for a in r[5].split(";") if a != r[1]}


def input_types() -> dict[str, str]:
    return {r[2]: r[3] for r in _rows(INPUT_COLUMNS_TEXT)}


def canonical_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(r[1], _SPARK_TYPES[r[2]], r[3] == "yes") for r in _rows(CANONICAL_COLUMNS_TEXT)]
    )


def input_columns_df(spark: SparkSession) -> DataFrame:
    rows = [(int(r[0]), r[1], r[2], r[3], r[4] == "yes", r[5].split(";")) for r in _rows(INPUT_COLUMNS_TEXT)]
    return spark.createDataFrame(
        rows,
        "position int, source_name string, standard_name string, input_type string, nullable boolean,"
        " aliases array<string>",
    )


def canonical_columns_df(spark: SparkSession) -> DataFrame:
    rows = [(int(r[0]), r[1], r[2], r[3] == "yes", r[4]) for r in _rows(CANONICAL_COLUMNS_TEXT)]
    return spark.createDataFrame(
        rows, "position int, name string, dtype string, nullable boolean, column_group string"
    )
