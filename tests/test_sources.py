"""Station list parsing, header-aware CSV ingest and the missing-file report."""

import os

import pytest
from pyspark.sql import functions as F

from isotherm.sources import listing, readings, stations

# (line, expected name, GSN flag, HCN/CRN flag)
STATION_LINES = [
    ("AA000000001  10.1167  -61.7833   10.1    ALPHA FORT   ", "ALPHA FORT", None, None),
    ("AB000000002  25.3330   55.5170   34.0    BETA INTER. AIRP   GSN     41196", "BETA INTER. AIRP", "GSN", "41196"),
    ("AC000000003  61.0  -149.0  40.0 AK GAMMA CITY  GSN HCN 70273", "AK GAMMA CITY GSN HCN", None, "70273"),
    ("AD000000004 1.0 2.0 3.0 DELTA 5", "DELTA", None, "5"),
    ("AE000000005 -1.5 2.25 -999.9 EPSILON GSN", "EPSILON", "GSN", None),
    ("AF000000006 1.0 2.0 3.0 ZETA HCN", "ZETA HCN", None, None),
    ("AG000000007 1.0 2.0 10", "", None, "10"),
    ("AH000000008\t4.0 5.0   6.0   ETA   TWO", "ETA TWO", None, None),
]


def test_station_lines_parse(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_text("\n".join([s[0] for s in STATION_LINES] + ["", "   "]) + "\n")
    df = stations.read_stations(spark, str(path))
    assert df.columns == ["station_id", "latitude", "longitude", "elevation", "station_name",
                          "GSN_flag", "HCN_CRN_flag"]
    got = {r.station_id: r for r in df.collect()}
    assert len(got) == len(STATION_LINES)  # blank lines dropped
    for line, name, gsn, hcn in STATION_LINES:
        r = got[line.split()[0]]
        assert (r.station_name, r.GSN_flag, r.HCN_CRN_flag) == (name, gsn, hcn), line
    assert got["AB000000002"].latitude == 25.333 and got["AB000000002"].longitude == 55.517
    assert got["AE000000005"].elevation == -999.9
    assert got["AG000000007"].elevation == 10.0


def test_bad_coordinate_is_null(spark):
    df = stations.parse_station_lines(spark.createDataFrame([("ZZ1 north 2.0 3.0 NAME",)], "value string"))
    r = df.collect()[0]
    assert r.latitude is None and r.longitude == 2.0 and r.station_name == "NAME"


def _write(dirpath, name, text):
    p = os.path.join(dirpath, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def make_csv_dir(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    _write(d, "a.csv", 'STATION,DATE,TAVG,PRCP\n"A1","2001-03","12.5","3.0"\nA1,2001-04,13.5,\n')
    _write(d, "b.csv", "STATION,DATE,PRCP,TAVG\nB1,2001-03,7.0,20.0\n")
    _write(d, "c.csv", '"STATION","DATE","NAME","LATITUDE","LONGITUDE"\n'
                       '"C1","2002-01","PRAHA, EZ","50.1","14.4"\n')
    _write(d, "d.csv", "STATION,DATE,LATITUDE,LONGITUDE,TAVG,PRCP\nD1,2003-05,1.0,2.0,abc,4.0\nD1,2003-06,1.0,2.0\n")
    return d


@pytest.mark.parametrize("whole_files", [True, False])
def test_header_aware_ingest(spark, tmp_path, whole_files):
    d = make_csv_dir(tmp_path)
    df = readings.read_readings(spark, str(d / "*.csv"), flag_ragged=True, whole_files=whole_files)
    assert df.columns == ["STATION", "DATE", "LATITUDE", "LONGITUDE", "TAVG", "PRCP", "ragged"]
    rows = sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0], t[1]))
    assert rows == [
        ("A1", "2001-03", None, None, 12.5, 3.0, False),
        ("A1", "2001-04", None, None, 13.5, None, False),
        ("B1", "2001-03", None, None, 20.0, 7.0, False),   # aligned by name, not position
        ("C1", "2002-01", 50.1, 14.4, None, None, False),  # quoted comma kept in NAME
        ("D1", "2003-05", 1.0, 2.0, None, 4.0, False),     # bad number -> null
        ("D1", "2003-06", 1.0, 2.0, None, None, True),     # one value too few
    ]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_plans(spark, tmp_path):
    d = make_csv_dir(tmp_path)
    whole = _plan(readings.read_readings(spark, str(d / "*.csv"), whole_files=True))
    assert "Python" not in whole and "ArrowEval" not in whole
    # one pass over the files: no join, no shuffle
    assert "Join" not in whole and "Exchange" not in whole
    lines = _plan(readings.read_readings(spark, str(d / "*.csv"), whole_files=False))
    assert "Python" not in lines and "NestedLoop" not in lines
    # default: both branches in one plan, split by the file size the index knows
    both = _plan(readings.read_readings(spark, str(d / "*.csv")))
    assert "Union" in both and "file_size" in both


HEADER_LINES = [1, 7, 100]


@pytest.mark.parametrize("header_line", HEADER_LINES)
@pytest.mark.parametrize("rows", [12, 200_000])
def test_header_on_any_line_in_small_and_large_files(spark, tmp_path, header_line, rows):
    # About 200 bytes, and about 5 MB (beyond the whole-file limit).
    d = tmp_path / "any"
    d.mkdir()
    before = "".join(f"9,9999-01,note {i}\n" for i in range(header_line - 1))
    data = "".join(f"{i}.5,20{i % 100:02d}-01,S{i % 1000},some filler\n" for i in range(rows))
    _write(d, "f.csv", before + "TAVG,DATE,STATION,NOTE\n" + data)
    want = (rows, sum(i + 0.5 for i in range(rows)))
    for mode in (None, True, False):
        df = readings.read_readings(spark, str(d), file_pattern="*.csv", whole_files=mode)
        got = df.agg({"*": "count", "TAVG": "sum"}).first()
        assert (got["count(1)"], got["sum(TAVG)"]) == want, mode


def test_files_without_a_header_are_reported(spark, tmp_path):
    d = tmp_path / "some"
    d.mkdir()
    _write(d, "good.csv", "STATION,DATE,TAVG\nS,2001-01,1.0\n")
    _write(d, "bare.csv", "S,2001-01,1.0\n")
    _write(d, "blank.csv", "\n\n")
    found = readings.headerless_files(spark, str(d), file_pattern="*.csv").collect()
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in found) == ["bare.csv", "blank.csv"]


@pytest.mark.parametrize("whole_files", [True, False])
def test_only_listed_files_are_read(spark, tmp_path, whole_files):
    d = make_csv_dir(tmp_path)
    only = spark.createDataFrame([("a",), ("a",), ("zz",), (None,)], "station_id string")
    df = readings.read_readings(spark, str(d), file_pattern="*.csv", whole_files=whole_files, only=only, keep_path=True)
    assert {r.source_file.rsplit("/", 1)[1] for r in df.collect()} == {"a.csv"}


@pytest.mark.parametrize("whole_files", [True, False])
def test_not_a_number_is_missing(spark, tmp_path, whole_files):
    from isotherm.operators import clean, metrics

    d = tmp_path / "nan"
    d.mkdir()
    _write(d, "n.csv", "STATION,DATE,TAVG,PRCP\nS,2001-01,1.0,NaN\nS,2001-02,3.0,Infinity\nS,2001-03,2.0,4.0\n")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        rows = clean.clean_readings(readings.read_readings(spark, str(d), file_pattern="*.csv", whole_files=whole_files))
        for scale in (None, 6):
            r = metrics.station_year_means(rows, scale).first()
            assert (r.avg_temp, r.avg_precip) == (2.0, 4.0)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_ids_are_never_cut(spark):
    from isotherm.sources.standin import station_id

    keys = [1, 99_999, 100_000, 1_000_000, 1_000_001, 123_456_789]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select(station_id("k").alias("s")).collect()
    assert [r.s for r in rows] == ["ST000001", "ST099999", "ST100000", "ST1000000", "ST1000001", "ST123456789"]


def test_missing_stations_from_listing(spark, tmp_path):
    d = make_csv_dir(tmp_path)
    st = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "station_id string")
    present = listing.present_station_ids(spark, str(d))
    assert sorted(r.station_id for r in present.collect()) == ["a", "b", "c", "d"]
    missing = listing.missing_stations(st, present)
    assert [r.station_id for r in missing.collect()] == ["e"]
    # the listing reads no file content
    plan = present._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_station_file_paths(spark):
    st = spark.createDataFrame([("X1",)], "station_id string")
    row = listing.station_file_paths(st, "s3a://bucket/raw/").collect()[0]
    assert row.path == "s3a://bucket/raw/X1.csv"


def test_csv_fields_edge_cases(spark):
    from isotherm.functions.text import csv_fields

    df = spark.createDataFrame(
        [("a,,b",), (",x",), ("a,b,",), ('"q,1","he said ""hi""",z',), ("",)], "line string"
    )
    got = [r.f for r in df.select(csv_fields("line").alias("f")).collect()]
    assert got == [["a", "", "b"], ["", "x"], ["a", "b", ""], ["q,1", 'he said "hi"', "z"], [""]]


@pytest.mark.parametrize("whole_files", [True, False])
def test_ingest_whole_file_set_without_prcp(spark, tmp_path, whole_files):
    d = tmp_path / "only"
    d.mkdir()
    _write(d, "x.csv", "DATE,STATION,TAVG\n2001-01,X,1.0\n")
    df = readings.read_readings(spark, str(d / "*.csv"), keep_path=True, whole_files=whole_files)
    r = df.collect()[0]
    assert (r.STATION, r.DATE, r.TAVG, r.PRCP) == ("X", "2001-01", 1.0, None)
    assert r.source_file.endswith("x.csv")
    assert df.filter(F.col("PRCP").isNotNull()).count() == 0


@pytest.mark.parametrize("whole_files", [True, False])
def test_ingest_repeated_header_blank_lines_and_crlf(spark, tmp_path, whole_files):
    d = tmp_path / "odd"
    d.mkdir()
    _write(d, "r.csv", "STATION,DATE,TAVG\r\nR,2001-01,1.5\r\n\r\nSTATION,DATE,TAVG\r\nR,2001-02,2.5\r\n")
    _write(d, "n.csv", "no header here\n1,2,3\n")  # no header: its lines are not readings
    df = readings.read_readings(spark, str(d / "*.csv"), whole_files=whole_files)
    assert sorted((r.STATION, r.DATE, r.TAVG) for r in df.collect()) == [("R", "2001-01", 1.5), ("R", "2001-02", 2.5)]


def test_ingest_line_mode_shuffle_join(spark, tmp_path, shuffle_joins):
    d = make_csv_dir(tmp_path)
    expected = readings.read_readings(spark, str(d), file_pattern="*.csv", whole_files=True)
    want = sorted(map(tuple, expected.collect()))
    shuffle_joins()
    df = readings.read_readings(spark, str(d), file_pattern="*.csv", whole_files=False)
    assert "SortMergeJoin" in _plan(df)
    assert sorted(map(tuple, df.collect())) == want


@pytest.fixture()
def listed_at_once(spark, monkeypatch):
    """Few stations go into a folder; ``[files of each listing]`` of the reads that follow."""
    from isotherm.plans import catalog

    monkeypatch.setattr(catalog, "STATIONS_LISTED", 3)
    counts, real = [], readings._text

    def text(*args, **more):
        made = real(*args, **more)
        counts.append(len(made.inputFiles()))
        return made

    monkeypatch.setattr(readings, "_text", text)
    return counts


def _equals_its_sql(spark, name):
    from isotherm.plans import catalog
    from tools.verify import compare, duckdb_connection

    from .conftest import SF_SMALL

    found = catalog.QUERIES[name](spark, SF_SMALL)
    ok, message = compare(found, duckdb_connection(SF_SMALL), catalog.ORACLE_SQL[name])
    assert ok, message


def _bounded(counts):
    # Small and large files are told apart in two listings of a folder.
    assert len(counts) > 2 and max(counts) < sum(counts[::2]), counts


def test_listed_ingest_lists_one_folder_of_stations_at_a_time(spark, listed_at_once):
    conf = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(conf, None)
    _equals_its_sql(spark, "listed_ingest")
    _bounded(listed_at_once)
    assert spark.conf.get(conf, None) == before


def test_sampled_ingest_lists_one_folder_of_stations_at_a_time(spark, listed_at_once):
    _equals_its_sql(spark, "sampled_ingest")
    _bounded(listed_at_once)


def test_headerless_files_lists_one_folder_of_stations_at_a_time(spark, listed_at_once):
    _equals_its_sql(spark, "headerless_files")
    assert len(listed_at_once) > 2 and max(listed_at_once) < 10, listed_at_once  # of 20 files
