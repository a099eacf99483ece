"""Property tests: Spark operators against brute-force Python on random small fixtures."""

import csv
import io
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from isotherm.functions.text import csv_fields
from isotherm.operators import regions
from isotherm.operators.literals import literal_table
from isotherm.sources import stations

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- station lines ----------------------------------------------------------

def parse_by_rules(line):
    """The station-line rules, written plainly for comparison."""
    t = line.split()
    hcn = gsn = None
    if t[-1].isascii() and t[-1].isdigit():
        hcn = t.pop()
    if t and t[-1] == "GSN":
        gsn = t.pop()
    return t[0], " ".join(t[4:]), gsn, hcn


word = st.sampled_from(["GSN", "HCN", "CRN", "AIRP", "7", "123", "X1", "NORTH", "GSNX", "00"])


@SETTINGS
@given(st.lists(st.tuples(st.lists(word, max_size=5), st.sampled_from([" ", "  ", "\t", " \t "])),
                min_size=1, max_size=20))
def test_station_parse_matches_rules(spark, specs):
    lines = []
    for i, (words, sep) in enumerate(specs):
        lines.append(sep.join([f"ID{i:04d}", "1.5", "-2.0", "30"] + words) + sep)
    df = stations.parse_station_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = sorted((r.station_id, r.station_name, r.GSN_flag, r.HCN_CRN_flag) for r in df.collect())
    assert got == sorted(parse_by_rules(x) for x in lines)


# --- CSV fields ------------------------------------------------------------

field = st.text(alphabet='ab,"1 .', max_size=6)


@SETTINGS
@given(st.lists(st.lists(field, min_size=1, max_size=6), min_size=1, max_size=20))
def test_csv_fields_match_csv_module(spark, rows):
    lines = []
    for r in rows:
        buf = io.StringIO()
        csv.writer(buf, lineterminator="").writerow(r)
        lines.append(buf.getvalue())
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {r.i: r.f for r in df.select("i", csv_fields("line").alias("f")).collect()}
    for i, x in enumerate(lines):
        expected = next(csv.reader([x])) if x else [""]
        assert got[i] == expected, x


# --- regional summaries -------------------------------------------------------

coord_lat = st.sampled_from([-95.0, -90.0, -45.5, -10.0, 0.0, 9.99, 10.0, 45.0, 89.9, 90.0, 120.0])
coord_lon = st.sampled_from([-200.0, -180.0, -100.0, -10.0, 0.0, 10.0, 99.5, 179.9, 180.0, 250.0])
year = st.integers(1995, 2001)
temp = st.integers(-2000, 5000).map(lambda h: h / 100)


def brute_summary(rows, req):
    _, a1, b1, a2, b2, y1, y2 = req
    hit = [t for (la, lo, y, t) in rows if a1 <= la <= a2 and b1 <= lo <= b2 and y1 <= y <= y2]
    if not hit:
        return None, 0
    hundredths = sum(round(t * 100) for t in hit)
    n = len(hit)
    q = (2 * abs(hundredths) + n) // (2 * n)  # half away from zero
    return math.copysign(q, hundredths) / 100 if q else 0.0, n


@SETTINGS
@given(st.lists(st.tuples(coord_lat, coord_lon, year, temp), min_size=1, max_size=40),
       st.lists(st.tuples(coord_lat, coord_lon, coord_lat, coord_lon, year, year), min_size=1, max_size=8),
       st.sampled_from([1.0, 10.0, 30.0]))
def test_region_summary_many_matches_brute_force(spark, rows, reqs, cell):
    clean = spark.createDataFrame(
        [(f"S{i}", la, lo, y, t) for i, (la, lo, y, t) in enumerate(rows)],
        "STATION string, LATITUDE double, LONGITUDE double, YEAR int, TAVG double",
    )
    requests = [(i, *r) for i, r in enumerate(reqs)]
    req_df = literal_table(spark, requests, "region_id int, lat1 double, lon1 double, lat2 double, "
                                            "lon2 double, start_year int, end_year int")
    got = {r.region_id: (r.average_temperature, r.data_points)
           for r in regions.region_summary_many(clean, req_df, cell_degrees=cell).collect()}
    for req in requests:
        exp = brute_summary(rows, req)
        assert got[req[0]] == exp, (req, got[req[0]], exp)


# --- country lookup ------------------------------------------------------------

box = st.tuples(st.sampled_from(["P", "Q", "R", "S"]), coord_lat, coord_lat, coord_lon, coord_lon)


def brute_country(lat, lon, boxes):
    hits = [((a2 - a1) * (b2 - b1), c) for c, a1, a2, b1, b2 in boxes
            if a1 <= lat < a2 and b1 <= lon < b2]
    return min(hits)[1] if hits else None


@SETTINGS
@given(st.lists(st.tuples(coord_lat, coord_lon), min_size=1, max_size=30), st.lists(box, min_size=1, max_size=8),
       st.sampled_from([1.0, 10.0, 30.0]))
def test_station_country_matches_brute_force(spark, points, boxes, cell):
    st_df = spark.createDataFrame([(f"S{i}", la, lo) for i, (la, lo) in enumerate(points)],
                                  "station_id string, latitude double, longitude double")
    box_df = spark.createDataFrame(boxes, "country string, lat_min double, lat_max double, "
                                          "lon_min double, lon_max double")
    got = {r.station_id: r.country for r in regions.station_country(st_df, box_df, cell_degrees=cell).collect()}
    cut = {r.station_id: r.country
           for r in regions.station_country(st_df, box_df, cell_degrees=cell, dense_boxes=1).collect()}
    for i, (la, lo) in enumerate(points):
        assert got[f"S{i}"] == brute_country(la, lo, boxes), (la, lo)
        assert cut[f"S{i}"] == got[f"S{i}"], (la, lo)


# --- the cleaning chain ---------------------------------------------------------

def clean_by_rules(date, tavg, prcp):
    """Missing -> range -> F to C -> year/month/season -> half-up rounding, written plainly."""
    from decimal import ROUND_HALF_UP, Decimal

    if tavg is None or not (-20 <= tavg <= 122):
        return None
    t = (tavg - 32) * 5 / 9 if tavg > 50 else tavg
    half_up = lambda v: None if v is None else float(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    year = int(date[:4]) if date and date[:4].isdigit() else None
    month = int(date[5:7]) if date and date[5:7].isdigit() else None
    season = ("Spring" if month in (3, 4, 5) else "Summer" if month in (6, 7, 8)
              else "Autumn" if month in (9, 10, 11) else "Winter")
    return (half_up(t), half_up(prcp), year, month, season)


# Whole degrees above 50 (converted values never sit on a rounding tie) and
# 2-decimal values elsewhere, so Python's decimal rounding is an exact reference.
tavg_value = st.one_of(st.none(), st.integers(-3000, 5000).map(lambda h: h / 100), st.integers(-30, 130).map(float))
date_value = st.one_of(st.none(), st.builds(lambda y, m: f"{y}-{m:02d}", st.integers(1760, 2030), st.integers(1, 12)))


@SETTINGS
@given(st.lists(st.tuples(date_value, tavg_value, st.one_of(st.none(), st.integers(0, 99999).map(lambda h: h / 100))),
                min_size=1, max_size=40))
def test_clean_readings_matches_rules(spark, rows):
    from isotherm.operators.clean import clean_readings

    df = spark.createDataFrame(
        [(f"S{i}", d, 0.0, 0.0, t, p) for i, (d, t, p) in enumerate(rows)],
        "STATION string, DATE string, LATITUDE double, LONGITUDE double, TAVG double, PRCP double",
    )
    got = {r.STATION: (r.TAVG, r.PRCP, r.YEAR, r.MONTH, r.SEASON) for r in clean_readings(df).collect()}
    expected = {f"S{i}": clean_by_rules(d, t, p) for i, (d, t, p) in enumerate(rows)}
    assert got == {k: v for k, v in expected.items() if v is not None}


# --- exact means, independent of partitioning --------------------------------------

@SETTINGS
@given(st.lists(st.tuples(st.integers(1995, 1997), st.sampled_from(["Winter", "Spring"]),
                          st.integers(-2000, 5000).map(lambda h: h / 100)), min_size=1, max_size=60),
       st.integers(1, 16))
def test_seasonal_means_exact_for_any_partitioning(spark, rows, parts):
    from collections import defaultdict
    from decimal import ROUND_HALF_UP, Decimal

    from isotherm.operators.metrics import seasonal_avg

    df = spark.createDataFrame(rows, "YEAR int, SEASON string, TAVG double").repartition(parts)
    got = {(r.YEAR, r.SEASON): r.AVG_SEASONAL_TEMP for r in seasonal_avg(df).collect()}
    groups = defaultdict(list)
    for y, s, t in rows:
        groups[(y, s)].append(Decimal(repr(t)))
    expected = {k: float((sum(v) / len(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for k, v in groups.items()}
    assert got == expected


# --- row index and year change ------------------------------------------------------

@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=200, unique=True), st.integers(1, 12))
def test_row_index_contiguous_in_order(spark, values, parts):
    from isotherm.operators.sampling import with_row_index

    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(parts)
    got = sorted((r.row_index, r.v) for r in with_row_index(df, order_by=["v"]).collect())
    assert got == list(enumerate(sorted(values)))


@SETTINGS
@given(st.lists(st.tuples(st.integers(1900, 2020), st.integers(-50, 50)), min_size=1, max_size=30,
                unique_by=lambda t: t[0]))
def test_year_change_uses_previous_present_year(spark, years):
    from isotherm.operators.change import year_change

    df = spark.createDataFrame([(y, float(t), None) for y, t in years],
                               "YEAR int, rounded_global_avg_temp double, global_avg_precip double")
    got = {r.YEAR: (r.prev_rounded_global_avg_temp, r.temp_change) for r in year_change(df).collect()}
    ordered = sorted(years)
    expected = {ordered[0][0]: (None, None)}
    for (py, pt), (y, t) in zip(ordered, ordered[1:]):
        expected[y] = (float(pt), float(t - pt))
    assert got == expected


# --- consistency filter and aligned unions -------------------------------------------

small = st.one_of(st.none(), st.integers(-3, 3).map(float))


@SETTINGS
@given(st.lists(st.tuples(small, small, small), min_size=1, max_size=40))
def test_consistency_filter_matches_two_filters(spark, rows):
    from isotherm.operators.clean import consistency_filter

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, TMAX double, TAVG double, TMIN double")
    got = sorted(r.i for r in consistency_filter(df).collect())

    def keep(hi, mid, lo):
        if None in (hi, mid, lo):
            return False
        return (hi >= mid >= lo) and ((hi > mid > lo) or (hi == mid == lo))
    assert got == [i for i, r in enumerate(rows) if keep(*r)]


@SETTINGS
@given(st.lists(st.permutations(["STATION", "DATE", "LATITUDE", "LONGITUDE", "TAVG", "PRCP", "EXTRA"])
                .flatmap(lambda p: st.integers(1, 7).map(lambda k: p[:k])), min_size=1, max_size=5))
def test_union_aligned_any_column_subsets(spark, layouts):
    from isotherm.operators.union import union_aligned
    from isotherm.schemas import READING_COLUMNS

    values = {"STATION": "'S'", "DATE": "'2001-01'", "LATITUDE": "1.0D", "LONGITUDE": "2.0D",
              "TAVG": "3.0D", "PRCP": "4.0D", "EXTRA": "'x'"}
    parts = [spark.range(1).selectExpr(*[f"{values[c]} AS {c}" for c in cols]) for cols in layouts]
    out = union_aligned(parts).collect()
    plain = {"STATION": "S", "DATE": "2001-01", "LATITUDE": 1.0, "LONGITUDE": 2.0, "TAVG": 3.0, "PRCP": 4.0}
    expected = sorted((tuple(plain[c] if c in cols else None for c in READING_COLUMNS) for cols in layouts), key=repr)
    assert all(list(r.asDict()) == READING_COLUMNS for r in out)
    assert sorted((tuple(r) for r in out), key=repr) == expected
