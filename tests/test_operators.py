"""Small literal fixtures with results worked out by hand."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from obsguard.catalogs import contract
from obsguard.catalogs import dimensions as dim
from obsguard.catalogs import rulebook as R
from obsguard.functions import scalars as S
from obsguard.operators import canonical as C
from obsguard.operators import coded as K
from obsguard.operators import framework as FW
from obsguard.operators import grid as G
from obsguard.operators import row_rules as RR
from obsguard.operators import summary as SM
from obsguard.operators import temporal as TP
from obsguard.plans import quality as Q
from obsguard.plans import whole_run as WR
from obsguard.sinks import writers as W
from obsguard.sources import files as SF
from obsguard.sources import listing as SL
from obsguard.sources import readers as SR


# --- files --------------------------------------------------------------------------------------


def test_ignored_names_and_extensions(spark):
    names = {
        "raw/a/x.XLSX": False, "raw/~$x.xlsx": True, "raw/.hidden.xlsx": True, "raw/Thumbs.DB": True,
        "raw/.git/x.xlsx": True, "raw/_x.xlsx": False, "raw/../x.xlsx": False, "desktop.ini": True,
    }
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = {r[0]: r[1] for r in df.select("path", SF.is_ignored(F.col("path"))).collect()}
    assert got == names
    kept = {r[0] for r in SF.select_files(df, ["xlsx ", ""]).collect()}
    assert kept == {"raw/a/x.XLSX", "raw/_x.xlsx", "raw/../x.xlsx"}


def test_first_file_in_source_order_wins(spark):
    rows = [(1, "B/x.csv", "h"), (0, "z/y.csv", "h"), (0, "Z/a.csv", "h"), (0, "q.csv", "other")]
    df = spark.createDataFrame(rows, "source_ordinal int, path string, sha256 string").withColumn("relative_path", F.col("path"))
    got = {r["path"]: r["duplicate_of"] for r in SF.mark_duplicate_files(df).collect()}
    assert got == {"Z/a.csv": None, "z/y.csv": "Z/a.csv", "B/x.csv": "Z/a.csv", "q.csv": None}


@pytest.mark.parametrize(
    ("path", "source", "station"),
    [
        ("data/raw/excel/sphi/f.xlsx", "excel", "SPHI"), ("data/raw/EXCEL/ f.xlsx", "excel", "F.XLSX"),
        ("data/raw/f.xlsx", "excel", "UNKNOWN"), ("data/raw/excel", "excel", "UNKNOWN"),
    ],
)
def test_station_from_path(spark, path, source, station):
    df = spark.createDataFrame([(path, source)], "p string, s string")
    assert df.select(SF.station_from_path(F.col("p"), F.col("s"))).first()[0] == station


def test_discovery_reads_real_files(spark, tmp_path):
    base = tmp_path / "raw"
    (base / "csv" / "SPHI").mkdir(parents=True)
    (base / "csv" / "SPHI" / "a.csv").write_text("1,2\n")
    (base / "csv" / "SPHI" / "b.CSV").write_text("1,2\n")
    (base / "csv" / "SPHI" / "empty.csv").write_text("")
    (base / "csv" / "note.txt").write_text("x")
    found = SF.discover(
        spark,
        [
            {"type": "csv", "directory": str(base / "csv"), "extensions": ["csv"], "enabled": True},
            {"type": "metar", "directory": str(base / "metar"), "extensions": [".txt"], "enabled": True},
        ],
        root=str(tmp_path),
    )
    marked = SF.mark_duplicate_files(found).collect()
    assert {(r["filename"], r["duplicate_of"]) for r in marked} == {("a.csv", None), ("b.CSV", "raw/csv/SPHI/a.csv")}
    assert marked[0]["size_bytes"] == 4 and marked[0]["extension"] == ".csv"


# --- grids --------------------------------------------------------------------------------------


def _grid(spark, rows):
    df = spark.createDataFrame(rows, "source_file string, source_sheet string, source_row int, cells array<string>")
    return G.blank_cells_to_null(df)


def test_sheet_profile_and_cleaning(spark):
    rows = [
        ("f", "s", 1, [" ", "\t", "", " "]),
        ("f", "s", 2, ["A", "", "", "D"]),
        ("f", "s", 3, ["1", "", "x"]),
        ("f", "s", 4, [None, None, None, None]),
        ("f", "blank", 1, ["", " "]),
        ("f", "wide", 1, [str(i) for i in range(70)]),
    ]
    grid = _grid(spark, rows)
    profile = {r["source_sheet"]: r for r in G.profile_sheets(grid).collect()}
    s = profile["s"]
    assert (s["rows_before_cleanup"], s["columns_before_cleanup"], s["empty_rows_removed"], s["rows"]) == (4, 4, 2, 2)
    assert s["empty_column_positions"] == [2] and s["columns"] == 3 and s["header"] == ["A", None, "D"]
    head = s["headerless_columns_with_data"][0]
    assert (head["position"], head["excel_column"], head["suggested_name"]) == (2, "B", "UNKNOWN_02")
    assert profile["blank"]["rows"] == 0 and profile["wide"]["columns"] == 70
    cleaned = {
        (r["source_sheet"], r["source_row"]): r["cells"] for r in G.clean_grid(grid, G.profile_sheets(grid)).collect()
    }
    assert cleaned[("s", 2)] == ["A", None, "D"] and cleaned[("s", 3)] == ["1", "x", None]
    assert set(cleaned) == {("s", 2), ("s", 3), ("wide", 1)}


H = contract.input_headers()
CASES = {
    "exact": (H, 7, 100.0), "swapped": ([H[1], H[0], *H[2:]], 6, 85.71), "dropped": (H[:-1], 3, 42.86),
    "appended": ([*H, "Otro"], 3, 42.86), "repeated": ([*H, H[0]], 3, 42.86), "blanked": ([*H[:-1], None], 3, 42.86),
    "alias": (["OACI", *H[1:]], 3, 42.86), "untidy": ([f"  {H[0]} ", *H[1:]], 7, 100.0),
}


def test_header_validation_cases(spark):
    rows = [("f_" + n, "s", 1, h) for n, (h, _, _) in CASES.items()]
    rows += [("f_" + n, "s", 2, ["1"] * 53) for n in CASES]
    profile = G.normalize_headers(G.profile_sheets(_grid(spark, rows)))
    # Width 53 data rows keep a 53rd column, so compare on headers alone for the 52 column cases.
    trimmed = profile.withColumn(
        "headers",
        F.when(F.col("source_file").isin("f_appended", "f_repeated"), F.col("headers"))
        .when(F.col("source_file") == "f_dropped", F.slice("headers", 1, 51))
        .otherwise(F.slice("headers", 1, 52)),
    )
    got = {r["source_file"][2:]: (r["validation_passed"], r["integrity"]) for r in G.validate_headers(trimmed, H).collect()}
    assert got == {n: (p, i) for n, (_, p, i) in CASES.items()}
    fixed = G.validate_headers(G.resolve_header_aliases(trimmed, contract.header_aliases()), H)
    assert fixed.filter("source_file = 'f_alias'").first()["structure_valid"]


def test_file_without_sheets_is_invalid(spark):
    files = spark.createDataFrame([("f",), ("g",)], "source_file string")
    sheets = G.validate_headers(G.normalize_headers(G.profile_sheets(_grid(spark, [("f", "s", 1, H)]))), H)
    got = {r["source_file"]: r["structure_valid"] for r in G.file_validity(files, sheets).collect()}
    assert got == {"f": True, "g": False}


def test_grid_reader_keeps_row_numbers(spark, tmp_path):
    (tmp_path / "SPHI.csv").write_text('h1,h2\n"a,b",\n\n1,2,3\n"two\nlines","say ""x"""\n' + ",".join(map(str, range(200))) + "\n")
    rows = SR.read_grid(spark, str(tmp_path)).orderBy("source_row").collect()
    assert [r["source_row"] for r in rows] == [1, 2, 3, 4, 5, 7]
    assert rows[1]["cells"] == ["a,b", ""] and rows[2]["cells"] == [""] and rows[3]["cells"] == ["1", "2", "3"]
    assert rows[4]["cells"] == ["two\nlines", 'say "x"'] and rows[5]["cells"] == [str(i) for i in range(200)]
    assert rows[0]["source_sheet"] == "SPHI"


def test_grid_reader_decodes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Año;é\r\n1;2\r\n".encode("latin-1"))
    rows = SR.read_grid(spark, str(tmp_path), sep=";", encoding="ISO-8859-1").orderBy("source_row").collect()
    assert [r["cells"] for r in rows] == [["Año", "é"], ["1", "2"]]


def test_grid_reader_keeps_blank_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text(',a,b\n,,c\n"",x\n,\n,"q,r",\nx"y,z"\n"open,1\n2\n')
    rows = SR.read_grid(spark, str(tmp_path)).orderBy("source_row").collect()
    assert [r["cells"] for r in rows] == [["", "a", "b"], ["", "", "c"], ["", "x"], ["", ""], ["", "q,r", ""], ['x"y', 'z"'], ['"open', "1\n2"]]
    (tmp_path / "wide").mkdir()
    (tmp_path / "wide" / "b.csv").write_text("||a||" + '"' + "x" * 30_000 + '""|"' + "||c|d\n")
    (row,) = SR.read_grid(spark, str(tmp_path / "wide"), sep="||").collect()
    assert row["cells"] == ["", "a", "x" * 30_000 + '"|', "c|d"]


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_grid_reader_splits_files(spark, tmp_path, size):
    import csv
    import random

    pick = random.Random(size)
    want = {}
    for name in ("one", "two", "three"):
        records, line = [], 1
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            for _ in range(pick.randint(20, 60)):
                cells = ["".join(pick.choices('ab,"\né', k=pick.randint(0, 12))) for _ in range(pick.randint(1, 4))]
                csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerow(cells)
                records.append((line, cells))
                line += 1 + sum(c.count("\n") for c in cells)
        want[name] = records
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = SR.read_grid(spark, str(tmp_path)).orderBy("source_row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {n: [(r["source_row"], r["cells"]) for r in rows if r["source_sheet"] == n] for n in want} == want


def _executed(df):
    todo, nodes = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            nodes.append(node)
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return nodes


def test_grid_reader_sorts_no_lines(spark, tmp_path):
    # a split's lines are numbered while they are read: no task holds them to sort them
    (tmp_path / "a.csv").write_text('x,"y"\n"open\nclosed",z\n' * 20_000)
    grid = SR.read_grid(spark, str(tmp_path))
    rows = sorted(grid.collect(), key=lambda r: r["source_row"])
    assert [r["source_row"] for r in rows] == [n for k in range(20_000) for n in (3 * k + 1, 3 * k + 2)]
    assert rows[0]["cells"] == ["x", "y"] and rows[-1]["cells"] == ["open\nclosed", "z"]
    kinds = [(n.nodeName(), n.output().toString()) for n in _executed(grid)]
    assert not [k for k, columns in kinds if k in ("Sort", "Window") and "text#" in columns]


@pytest.mark.parametrize("batch", [1, 2, 7])
def test_grid_reader_counts_over_batches(spark, tmp_path, batch):
    text = 'a,b\n"one\ntwo\nthree",c\nd,"e""f"\n"four\n\nfive"\n' * 5
    for name in ("k", "l", "m"):
        (tmp_path / f"{name}.csv").write_text(text)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = SR.read_grid(spark, str(tmp_path)).collect()
    finally:
        for name in ("execution.arrow.maxRecordsPerBatch", "files.maxPartitionBytes", "files.openCostInBytes"):
            spark.conf.unset(f"spark.sql.{name}")
    cells = [["a", "b"], ["one\ntwo\nthree", "c"], ["d", 'e"f'], ["four\n\nfive"]]
    want = [(n, 8 * k + at, c) for n in "klm" for k in range(5) for at, c in zip((1, 2, 5, 6), cells)]
    assert sorted((r["source_sheet"], r["source_row"], r["cells"]) for r in rows) == sorted(want)


def test_sheets_of_any_width(spark):
    for width in (61, 62, 63, 64, 70, 200):
        head = [f"h{i}" for i in range(width)]
        row = ["" if i in (3, width - 2) else "x" for i in range(width)]
        head[3] = head[width - 2] = ""
        profile = G.profile_sheets(_grid(spark, [("f", "s", 1, [""] * width), ("f", "s", 2, head), ("f", "s", 3, row)])).collect()[0]
        assert profile["columns_before_cleanup"] == width and profile["empty_rows_removed"] == 1 and profile["header_row"] == 2
        assert profile["empty_column_positions"] == [4, width - 1] and len(profile["kept_positions"]) == width - 2


# --- rules --------------------------------------------------------------------------------------


def _flag(spark, rule, **values):
    types = {k: ("string" if isinstance(v, str) else "double") for k, v in values.items()}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in types.items()))
    (check,) = RR.row_checks(df, [rule], as_of="2024-01-01 00:00:00")
    return df.select(check.flag).first()[0]


@pytest.mark.parametrize(
    ("rule", "good", "bad"),
    [
        ("temperature_dew_point_above_air", dict(air_temperature_c=10.1, dew_point_temperature_c=10.3), dict(air_temperature_c=10.0, dew_point_temperature_c=10.3)),
        ("humidity_invalid_range", dict(relative_humidity_pct=100.0), dict(relative_humidity_pct=100.1)),
        ("humidity_dew_point_inconsistent", dict(relative_humidity_pct=100.0, air_temperature_c=20.0, dew_point_temperature_c=20.0), dict(relative_humidity_pct=90.0, air_temperature_c=20.0, dew_point_temperature_c=20.0)),
        ("pressure_qnh_qfe_relationship", dict(qnh_hpa=1000.0, qfe_hpa=1001.0), dict(qnh_hpa=1000.0, qfe_hpa=1001.5)),
        ("wind_direction_range", dict(wind_direction_deg=360.0), dict(wind_direction_deg=361.0)),
        ("wind_gust_significance", dict(wind_speed_kt=10.0, wind_gust_kt=20.0), dict(wind_speed_kt=10.0, wind_gust_kt=19.0)),
        ("wind_directional_extremes_inconsistent", dict(wind_direction_deg=0.0, wind_direction_ccw_deg=350.0, wind_direction_cw_deg=10.0), dict(wind_direction_deg=180.0, wind_direction_ccw_deg=350.0, wind_direction_cw_deg=10.0)),
        ("weather_invalid_code", dict(present_weather_1="+TSRAGR"), dict(present_weather_1="VCSH")),
        ("cloud_layers_not_ordered", dict(cloud_base_height_1_ft=100.0, cloud_base_height_3_ft=300.0), dict(cloud_base_height_1_ft=400.0, cloud_base_height_3_ft=300.0)),
        ("precipitation_negative", dict(accumulated_precipitation_mm=0.0), dict(accumulated_precipitation_mm=-0.1)),
    ],
)
def test_rule_passes_fails_and_skips(spark, rule, good, bad):
    assert _flag(spark, rule, **good) == "PASS"
    assert _flag(spark, rule, **bad) == R.RULES[rule].flag
    assert _flag(spark, rule, unrelated=1.0) == "NOT_CHECKED"


def test_cavok_cases(spark):
    assert _flag(spark, "visibility_cavok_inconsistent", metar="METAR CAVOK", prevailing_visibility_m=10000.0) == "PASS"
    assert _flag(spark, "visibility_cavok_inconsistent", metar="METAR CAVOK", prevailing_visibility_m=9000.0) == "ERROR"
    assert _flag(spark, "visibility_cavok_inconsistent", metar="METAR", prevailing_visibility_m=9000.0) == "NOT_APPLICABLE"


@pytest.mark.parametrize(
    ("flags", "score", "worst"),
    [
        ([], 100, None), (["PASS"], 100, "PASS"), (["SUSPECT", "PASS"], 90, "SUSPECT"), (["ERROR"], 70, "ERROR"),
        (["MISSING", "SUSPECT"], 75, "MISSING"), (["ERROR"] * 4, 0, "ERROR"), (["NOT_APPLICABLE", "NOT_CHECKED"], 100, "NOT_CHECKED"),
    ],
)
def test_score_and_worst_flag(spark, flags, score, worst):
    df = FW.evaluate(spark.range(1), [FW.Check(f"r{i}", F.lit(f), "v") for i, f in enumerate(flags)])
    row = FW.assess(df).first()
    assert (row["qc_score"], row["qc_flag"], row["qc_rule_count"]) == (score, worst, len(flags))
    failed = [f"r{i}" for i, f in enumerate(flags) if f in FW.FAILED]
    assert row["qc_flags"] == failed and row["qc_failed_rule_count"] == len(failed)


def test_time_series_cases(spark):
    def run(values, check, minutes=60):
        rows = [(i, "s", i * minutes * 60, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "id int, station string, t long, x double").withColumn("ts", F.timestamp_seconds("t"))
        out = TP.apply_checks(df, ["station"], ["ts", "id"], [check]).orderBy("id")
        return [r[check.name] for r in out.collect()]

    assert run([5.0] * 6, TP.persistence("p", "x", 6, 0.1)) == ["SUSPECT"] * 6
    assert set(run([5.0] * 5, TP.persistence("p", "x", 6, 0.1))) == {"NOT_CHECKED"}
    assert run([0.0, 13.0], TP.step("s", "x", "ts", 12.0, 30, 90)) == ["NOT_CHECKED", "SUSPECT"]
    assert run([0.0, 13.0], TP.step("s", "x", "ts", 12.0, 30, 90), minutes=120) == ["NOT_CHECKED"] * 2
    assert run([10.0, 30.0, 10.0], TP.spike("k", "x", 15.0)) == ["NOT_CHECKED", "SUSPECT", "NOT_CHECKED"]
    assert run([1.0, 2.0, 3.0] * 3, TP.repeated_pattern("r", "x")) == ["SUSPECT"] * 9


def test_missing_hours_and_runs(spark):
    hours = [h for h in range(6, 20) if h not in (9, 12, 13)]
    rows = [("s", f"2024-01-01 {h:02d}:00:00", "METAR") for h in hours]
    rows += [("s", "2024-01-01 09:47:00", "METAR"), ("s", "2024-01-01 12:00:00", "SPECI"), ("s", "1900-01-01 08:00:00", None)]
    df = spark.createDataFrame(rows, "station_id string, t string, kind string")
    obs = df.select("station_id", F.col("t").cast("timestamp_ntz").alias("local_ts"), "kind")
    stations = spark.createDataFrame([("s", "UTC"), ("silent", None)], "station_id string, timezone string")
    grid, got = TP.expected_grid(stations, "2024-01-01", "2024-01-01"), TP.received_hours(obs, report_type="kind")
    days = {r["station_id"]: r for r in TP.completeness(grid, got).collect()}
    day = days["s"]
    assert (day["expected"], day["received"], day["missing"], day["completeness_pct"]) == (14, 11, 3, 78.57)
    assert days["silent"]["received"] == 0
    run = TP.missing_runs(grid, got).filter("station_id = 's'").collect()
    assert [(r["missing_count"], r["first_hour"], r["last_hour"]) for r in run] == [(2, 12, 13)]
    zoned = TP.with_station_zone(spark.createDataFrame([("s",), ("silent",), ("x",)], "station_id string"), stations)
    assert {r[0]: r[1] for r in zoned.collect()} == {"s": "UTC", "silent": "America/Lima", "x": "America/Lima"}


# --- catalogs, canonical, sinks -----------------------------------------------------------------


def test_catalog_sizes(spark):
    assert len(H) == 52 and len(contract.canonical_schema()) == 67
    assert dim.stations(spark).count() == 34 and dim.units(spark).count() == 18 and dim.variables(spark).count() == 75
    assert dim.select_variables(dim.variables(spark), enabled=True).count() == 41
    assert dim.stations(spark).filter("timezone IS NULL").count() == 1
    fixed = dim.stations(spark, {"Antarctica/King_George_Island": "America/Punta_Arenas"})
    assert fixed.filter("timezone IS NULL").count() == 0
    assert FW.audit_rules(R.rules_df(spark), list(R.FLAG_CODES)).count() == 0
    assert FW.audit_schema(contract.canonical_columns_df(spark)).count() == 0
    spellings = dim.unit_aliases(spark)
    assert spellings.groupBy("alias").agg(F.countDistinct("unit_id").alias("n")).filter("n > 1").count() == 0


def test_headers_resolve_to_the_contract(spark):
    folded = spark.createDataFrame([(H,)], "h array<string>").select(S.nfkc_array(F.col("h"))).first()[0]
    assert folded == H


def test_canonical_projection_rejects_extras(spark):
    with pytest.raises(ValueError, match="outside"):
        C.to_canonical(spark.range(1), fill_missing=True)
    with pytest.raises(ValueError, match="missing"):
        C.to_canonical(spark.range(1).select(F.lit("x").alias("station_id")))
    out = C.to_canonical(spark.range(1).select(F.lit("x").alias("station_id")), fill_missing=True)
    assert out.schema.fieldNames() == contract.canonical_schema().fieldNames()


def test_quality_stages_keep_every_row(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    obs = df.select(
        F.col("event_id").alias("record_id"), F.col("user_id").cast("string").alias("station_id"),
        F.col("ts").alias("datetime_utc"), (F.col("value") / 10).alias("air_temperature_c"),
        F.lit(None).cast("double").alias("relative_humidity_pct"), F.lit(1000.0).alias("qnh_hpa"),
        F.lit(4.0).alias("wind_speed_kt"), F.lit(10.0).alias("wind_direction_deg"), F.lit(9999.0).alias("prevailing_visibility_m"),
        F.lit(20.0).alias("minimum_temperature_c"), F.lit(10.0).alias("maximum_temperature_c"),
        F.lit(1.0).alias("dew_point_temperature_c"), F.lit(990.0).alias("qfe_hpa"), F.lit(None).cast("double").alias("wind_gust_kt"),
    )
    final = Q.final_quality(obs, dim.stations(spark), "2024-03-01 00:00:00", null_columns=["air_temperature_c"])
    rows = final.select("record_id", "qc_score", "qc_flag", F.size("qc_results").alias("n")).collect()
    assert len(rows) == len({r["record_id"] for r in rows}) == df.count()
    assert all(0 <= r["qc_score"] <= 100 and r["qc_flag"] == "ERROR" for r in rows)
    again = final.repartition(3).select("record_id", "qc_score").collect()
    assert sorted(map(tuple, again)) == sorted((r["record_id"], r["qc_score"]) for r in rows)


def test_stop_gate_and_stage_store(spark, tmp_path):
    bad = spark.createDataFrame([("error",), ("success",)], "status string")
    with pytest.raises(W.StopOnError):
        W.raise_if_failed(bad)
    assert W.raise_if_failed(bad, stop=False) == 1
    assert W.load_stage(spark, str(tmp_path), "r", "s") is None
    W.save_stage(spark, bad, str(tmp_path), "r", "s", {"rows": 2})
    assert W.load_stage(spark, str(tmp_path), "r", "s").count() == 2


def test_format_size_and_letters(spark):
    df = spark.createDataFrame([(0,), (1023,), (1024,), (5 * 1024**4 * 1024,)], "n long")
    assert [r[0] for r in df.select(S.format_size(F.col("n"))).collect()] == ["0.00 B", "1,023.00 B", "1.00 KB", "5,120.00 TB"]
    cols = spark.createDataFrame([(1,), (26,), (27,), (702,), (703,), (18278,)], "n int")
    assert [r[0] for r in cols.select(S.column_letter(F.col("n"))).collect()] == ["A", "Z", "AA", "ZZ", "AAA", "ZZZ"]


# --- plans --------------------------------------------------------------------------------------


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df):
    """The plan that was run."""
    return _plan(df).split("+- == Initial Plan ==")[0]


def test_plans_have_no_cross_joins_and_share_one_exchange(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    long_df = events.selectExpr("event_id", "user_id AS station_id", "ts", "event_type AS variable", "value")
    checks = [TP.step("a", "value", "ts", 1.0), TP.spike("b", "value", 1.0), TP.persistence("c", "value", 4, 0.0)]
    checked = TP.apply_checks(long_df, ["station_id"], ["ts", "event_id"], checks)
    checked.collect()
    plan = _final(checked)
    # the input is read and exchanged once, by station and slice; the other exchange holds the rows next to a cut
    assert plan.count("Scan parquet") == 1
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(station_id" in line and "ReusedExchange" not in line]
    assert len([line for line in dealt if "_slice0" in line]) == 1 and len(dealt) == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    from obsguard.operators.joins import neighbour_pairs

    stations = events.selectExpr("user_id AS station_id", "value AS latitude", "value AS longitude")
    plan = _plan(neighbour_pairs(stations))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = SM.period_means(events.filter("event_type = 'click'"), ["user_id"], "ts", "day")
    plan = _plan(out)
    assert "props" not in plan and "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan


def test_row_checks_run_on_a_stream_schema(spark):
    stream = spark.readStream.format("rate").load().select(F.col("value").cast("double").alias("relative_humidity_pct"))
    assert FW.assess(FW.evaluate(stream, RR.row_checks(stream, ["humidity_invalid_range"]))).isStreaming


# --- listings, digests, discovery ---------------------------------------------------------------


def test_listing_sees_hidden_and_empty_files_at_any_depth(spark, tmp_path):
    want = {}
    for k in range(70):
        folder = tmp_path / f"st{k % 9}" / f"y{k}" / "deep" / "er"
        folder.mkdir(parents=True)
        (folder / f"f {k}.csv").write_bytes(b"x" * k)
        want[str(folder / f"f {k}.csv")] = k
    (tmp_path / ".hidden.csv").write_text("h")
    (tmp_path / "_note.csv").write_text("")
    want |= {str(tmp_path / ".hidden.csv"): 1, str(tmp_path / "_note.csv"): 0}
    got = {r["path"]: r["size_bytes"] for r in SL.list_files(spark, str(tmp_path)).collect()}
    assert got == want
    flat = SL.list_files(spark, str(tmp_path), recursive=False).collect()
    assert {r["path"] for r in flat} == {str(tmp_path / ".hidden.csv"), str(tmp_path / "_note.csv")}
    assert SL.list_files(spark, str(tmp_path / "absent")).collect() == []


def test_digests_run_over_blocks(spark, tmp_path, monkeypatch):
    import hashlib

    (tmp_path / "large.csv").write_bytes(bytes(range(256)) * 20_000)  # five blocks
    (tmp_path / "one.CSV").write_bytes(b"\x00\xff\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    files = SF.discover(spark, [{"type": "csv", "directory": str(tmp_path), "extensions": ["csv"], "enabled": True}])
    got = {r["filename"]: (r["sha256"], r["size_bytes"]) for r in files.collect()}
    assert got == {n: (hashlib.sha256((tmp_path / n).read_bytes()).hexdigest(), (tmp_path / n).stat().st_size) for n in ("large.csv", "one.CSV")}


def test_discovery_warns_of_what_it_passes_over(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "void.csv").write_text("")
    (tmp_path / "a" / "~$void.csv").write_text("")
    (tmp_path / "a" / "void.txt").write_text("")
    sources = [
        {"type": "csv", "directory": str(tmp_path / "a"), "extensions": ["csv"], "enabled": True},
        {"type": "metar", "directory": "", "extensions": ["txt"], "enabled": True},
        {"type": "bufr", "directory": str(tmp_path), "extensions": [" "], "enabled": True},
        {"type": "xlsx", "directory": str(tmp_path / "none"), "extensions": ["xlsx"], "enabled": True},
        {"type": "off", "directory": "", "extensions": [], "enabled": False},
    ]
    got = {(r["source_type"], r["problem"], r["path"]) for r in SF.discovery_warnings(spark, sources).collect()}
    assert got == {
        ("csv", "empty_file", str(tmp_path / "a" / "void.csv")), ("metar", "no_path", None),
        ("bufr", "no_extensions", str(tmp_path)), ("xlsx", "folder_missing", str(tmp_path / "none")),
    }


def test_a_rerun_replaces_its_own_folders_only(spark, tmp_path):
    df = spark.createDataFrame([(2020, 1, "a"), (2020, 2, "b"), (2021, 1, "c")], "year int, month int, v string")
    W.write_layout(df, str(tmp_path / "out"), "monthly")
    W.write_layout(df.filter("year = 2020 and month = 2").withColumn("v", F.lit("new")), str(tmp_path / "out"), "monthly")
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("year", "month", "v").collect()) == [(2020, 1, "a"), (2020, 2, "new"), (2021, 1, "c")]


def test_export_metrics_belong_to_the_rows_written(spark, tmp_path):
    df = spark.range(1000).withColumn("even", F.col("id") % 2 == 0)
    got = W.write_observed(df, str(tmp_path / "x"), {"rows": F.count(F.lit(1)), "even": F.count_if("even")})
    assert got == {"rows": 1000, "even": 500} and spark.read.parquet(str(tmp_path / "x")).count() == 1000


# --- contract, duplicates, whole run ------------------------------------------------------------


def test_casts_that_fail_become_findings(spark):
    df = spark.createDataFrame([("SPJC", 300, "x", 1), (None, 12, "7.5", 2)], "station_id string, month int, qnh_hpa string, source_row int")
    rows = C.canonical_with_findings(df).orderBy("source_row").collect()
    found = [{(f["column"], f["problem"], f["value"]) for f in r["contract_findings"]} for r in rows]
    assert {("month", "cast_failed", "300"), ("month", "required_null", None), ("qnh_hpa", "cast_failed", "x")} <= found[0]
    assert ("station_id", "required_null", None) in found[1] and rows[1]["qnh_hpa"] == 7.5 and rows[1]["month"] == 12
    assert not any(p == "cast_failed" for _, p, _ in found[1]) and len(rows[0]) == 68
    with pytest.raises(ValueError):
        C.canonical_with_findings(df.withColumn("stray", F.lit(1)))


def test_ordinals_over_slices(spark):
    rows = [(i, "a" if i % 3 else None, "x" if i % 2 else "y") for i in range(60)] + [(100, "b", None), (101, "b", None)]
    df = spark.createDataFrame(rows, "n long, k string, v string")
    got = {r["n"]: (r["duplicate_ordinal"], r["duplicate_kind"]) for r in TP.duplicate_ordinals(df, ["k"], ["k", "v"], "n", 7).collect()}
    seen, contents = {}, set()
    for n, k, v in rows:
        if k is None:
            assert got[n] == (None, "not_checked")
            continue
        seen[k] = seen.get(k, 0) + 1
        kind = "first" if seen[k] == 1 else "exact" if (k, v) in contents else "key"
        contents.add((k, v))
        assert got[n] == (seen[k], kind)


def test_expressions_are_audited_against_the_contract(spark):
    known = contract.canonical_schema().fieldNames()
    assert FW.audit_expressions(spark, R.EXPRESSION_RULES, known).collect() == []
    odd = {"a": "air_temp_c <= no_such + 0.2", "b": "wind_speed_kt >=", "c": "abs(qnh_hpa - qfe_hpa) < 1"}
    assert {tuple(r)[:2] for r in FW.audit_expressions(spark, odd, known).collect()} == {("a", "unknown_name"), ("b", "invalid_expression")}


def test_own_catalogues_hold_together(spark):
    assert FW.audit_rules(R.rules_df(spark), list(R.FLAG_CODES)).collect() == []
    columns = contract.canonical_columns_df(spark)
    assert FW.audit_schema(columns).collect() == [] and FW.audit_attributes(columns).collect() == []
    broken = columns.withColumn("dtype", F.when(F.col("position") != 3, F.col("dtype"))).drop("column_group")
    assert {tuple(r) for r in FW.audit_attributes(broken).collect()} == {("datetime_utc", "missing_dtype"), ("table", "missing_column_group")}
    named = dim.variables(spark).filter("unit is not null").select(F.col("canonical_name").alias("rule_id"), "unit")
    assert FW.audit_references(named, dim.unit_aliases(spark), "unit", "alias", "unknown_unit").collect() == []


def test_whole_run_by_hand(spark):
    schema = "record_id long, station_id string, datetime_utc timestamp_ntz, report_type string, source_file string, source_row int, air_temperature_c double, accumulated_precipitation_mm double, daily_precipitation_mm double"
    at = lambda d, h, m=0: __import__("datetime").datetime(2024, 1, d, h, m)
    rows = [(h, "sp1", at(3, h), "METAR", "f", h, 20.0 + h, 1.0, 14.0) for h in range(6, 20)]  # a complete day of UTC hours
    rows += [(30, " SP1 ", at(4, 6), "METAR", "f", 40, 20.0, None, None), (31, "SP1", at(4, 6), "METAR", "f", 39, 99.0, None, None)]
    rows += [(40, None, at(3, 7), "METAR", "f", 1, 20.0, None, None), (41, "SP1", None, "METAR", "f", 50, 20.0, None, None)]
    obs = spark.createDataFrame(rows, schema)
    stations = spark.createDataFrame([("SP1", "UTC"), ("SP1", "UTC")], "station_id string, timezone string")
    settings = WR.Settings("2024-02-01 00:00:00", "2024-01-03", "2024-01-05", limits={"air_temperature_c": (None, 50.0, None, 30.0)}, thresholds={"air_temperature_c": (5.0, 30.0)})
    df, items = WR.whole_quality(obs, stations, settings)
    got = df.collect()
    assert len(got) == len(rows) and {i.rule_id for i in items} == {r.rule_id for r in R.RULES.values() if r.enabled and not r.rule_id.startswith(("unit_", "datatype_", "completeness_null", "completeness_required"))}
    found = {}
    for r in got:
        for item, code in zip(items, r["qc_codes"], strict=True):
            found[r["record_id"], item.rule_id] = R.FLAG_ORDER[code - 1]
    assert found[10, "completeness_expected_observations"] == "PASS" and found[10, "completeness_consecutive_missing"] == "PASS"
    assert found[30, "completeness_expected_observations"] == "MISSING" and found[30, "completeness_consecutive_missing"] == "SUSPECT"
    assert found[40, "completeness_expected_observations"] == "NOT_CHECKED" and found[41, "temporal_step"] == "NOT_CHECKED"
    assert found[30, "datetime_duplicate_observation"] == "PASS" and found[31, "datetime_duplicate_observation"] == "ERROR"
    assert found[31, "range_above_physical_maximum"] == "ERROR" and found[31, "range_below_physical_minimum"] == "NOT_CHECKED"
    assert found[30, "datetime_non_chronological"] == "PASS" and found[10, "datetime_non_chronological"] == "PASS"
    assert found[10, "precipitation_accumulation_inconsistent"] == "PASS" and found[10, "identity_invalid_station_id"] == "PASS"
    detail = K.code_detail(df, ["record_id"], items).filter("record_id = 31 and rule_id = 'range_above_physical_maximum'").collect()
    assert [(r["observed_value"], r["severity"], r["message"]) for r in detail] == [("99.0", "error", "range_above_physical_maximum: error")]
    by_hand = {r["record_id"]: r for r in got}[31]
    assert by_hand["qc_status"] == "ERROR" and by_hand["qc_rule_count"] == len(items) and "range_above_physical_maximum" in by_hand["qc_flags"]
    counts = {(r["rule_id"], r["flag"]): r["observations"] for r in K.code_counts(df, [], items).collect()}
    assert counts["completeness_expected_observations", "MISSING"] == 2


def test_code_counts_bring_rows_together_before_codes_are_spread(spark):
    items = [K.Item("r1", "a"), K.Item("r2", "b")]
    rows = [(i, "hot" if i % 3 else f"s{i % 50}", [K.CODES["PASS"], K.CODES["ERROR" if i % 4 else "PASS"]]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, station string, qc_codes array<tinyint>")
    counts = K.code_counts(df, ["station"], items)
    got = {(r["station"], r["rule_id"], r["flag"]): r["observations"] for r in counts.collect()}
    want = Counter()
    for _, station, codes in rows:
        for item, code in zip(items, codes, strict=True):
            want[(station, item.rule_id, next(f for f, c in K.CODES.items() if c == code))] += 1
    assert got == want
    plan = _final(counts)
    # rows are dealt by a hash that the grouping does not know, so counts are added up and a hot key may be split
    assert plan.index("Generate") < plan.index("REBALANCE_PARTITIONS_BY_COL") and plan.count("HashAggregate") == 2


def test_stage_summaries_read_the_counts_once(spark):
    stages = list(R.STAGE_MODULES)
    rules = [R.rules_of_stage(s)[0] for s in stages]
    counts = spark.createDataFrame([(r, f, n) for n, r in enumerate(rules, 1) for f in ("PASS", "ERROR")], "rule_id string, flag string, observations long")
    out = {r["stage"]: (r["rule_id"], r["total_observations"]) for r in SM.stage_summaries(counts, stages).collect()}
    assert out == {s: (r, 2 * n) for n, (s, r) in enumerate(zip(stages, rules, strict=True), 1)}
    assert "Union" not in _plan(SM.stage_summaries(counts, stages))


def test_cells_are_cleaned_once_a_row(spark):
    rows = [("f", "s", n, c) for n, c in enumerate([[" ", ""], ["a", " "], ["1", "2"]], 1)]
    raw = spark.createDataFrame(rows, "source_file string, source_sheet string, source_row long, cells array<string>")
    grid = G.blank_cells_to_null(raw)
    assert [r["cells"] for r in grid.orderBy("source_row").collect()] == [[None, None], ["a", None], ["1", "2"]]
    profile = G.profile_sheets(grid)
    assert profile.select("rows_before_cleanup", "rows", "header").first()[:] == (3, 2, ["a", None])
    for df in (G.sheet_sizes(grid), G.clean_grid(grid, profile)):
        # no filter works cells or masks out a second time
        assert not [line for line in _plan(df).split("\n") if "Filter" in line and "ascii(" in line]
    plan = _plan(G.first_rows(grid, G.sheet_sizes(grid).persist()))
    assert "LeftSemi" in plan and plan.index("Generate") < plan.index("LeftSemi")
