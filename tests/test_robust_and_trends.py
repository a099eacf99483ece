"""Robust outliers, trends over the years, and counts observed while tables are written."""

import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isotherm.operators import clean, robust, trends
from isotherm.plans.batch import run_batch
from isotherm.sources import readings, snapshots

from .test_pipeline import station_list
from .test_sources import make_csv_dir

VALUES = "g string, TAVG double"


def mad(values):
    m = statistics.median(values)
    return statistics.median(abs(v - m) for v in values)


@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.just(float("nan")), st.integers(-50, 50).map(float))), max_size=60))
@settings(max_examples=25, deadline=None)
def test_small_groups_are_exact(spark, rows):
    got = {r.g: (r.n_values, r.median, r.mad) for r in robust.robust_stats(spark.createDataFrame(rows, VALUES), ["g"]).collect()}
    want = {}
    for g in "ab":
        v = [t for k, t in rows if k == g and t is not None and t == t]
        if v:
            want[g] = (len(v), statistics.median(v), mad(v))
    assert got == want


@pytest.mark.parametrize("n", [511, 512, 513])
def test_groups_about_the_size_of_the_grid(spark, n):
    rng = random.Random(n)
    rows = [("a", rng.gauss(0, 10)) for _ in range(n)]
    r = robust.robust_stats(spark.createDataFrame(rows, VALUES).repartition(3), ["g"]).first()
    v = sorted(t for _, t in rows)
    if n < robust.GRID:
        assert (r.median, r.mad) == (statistics.median(v), mad(v))
    assert abs(sum(x <= r.median for x in v) / n - 0.5) <= robust.RANK_ERROR


@pytest.mark.parametrize("scale", [lambda x: x, lambda x: x ** 3, lambda x: round(x)])
def test_large_groups_are_within_the_stated_error(spark, scale):
    rng = random.Random(3)
    v = [float(scale(rng.gauss(5, 10))) for _ in range(60_000)]
    r = robust.robust_stats(spark.createDataFrame([("a", x) for x in v], VALUES).repartition(7), ["g"]).first()
    assert r.n_values == len(v)
    for value, of in ((r.median, v), (r.mad, [abs(x - r.median) for x in v])):
        below, upto = sum(x < value for x in of) / len(of), sum(x <= value for x in of) / len(of)
        assert below - robust.RANK_ERROR <= 0.5 <= upto + robust.RANK_ERROR


def test_significant_outliers(spark):
    rows = [("S", f"20{y:02d}-01", 10.0 + y % 5, "x") for y in range(20)] + [("S", "2030-01", 60.0, "x"), ("S", "2031-01", -40.0, "y")]
    rows += [("S", f"20{y:02d}-07", 30.0, "x") for y in range(20)] + [("S", "2030-07", 90.0, "x")]  # MAD 0: not judged
    rows += [("T", f"20{y:02d}-01", float(y), "x") for y in range(5)] + [("T", "2030-01", 500.0, "x")]  # too few
    rows += [("S", None, 1.0, "x"), ("S", "2003-01", None, "x"), ("S", "2003-01", float("nan"), "x"), (None, "2001-01", 3.0, "x")]
    rows += [(None, "2001-02", float(k % 4), "x") for k in range(12)] + [(None, "2001-02", 99.0, "z")]  # no site: judged together
    df = spark.createDataFrame(rows, "STATION string, DATE string, TAVG double, median string")
    with pytest.raises(Exception):
        robust.significant_outliers(df).collect()  # a column of a result's name
    got = robust.significant_outliers(df.withColumnRenamed("median", "note")).collect()
    assert sorted((str(r.STATION), r.TAVG, r.note, r.MONTH) for r in got) == [
        ("None", 99.0, "z", 2), ("S", -40.0, "y", 1), ("S", 60.0, "x", 1)]
    v = [10.0 + y % 5 for y in range(20)] + [60.0, -40.0]
    one = next(r for r in got if r.TAVG == 60.0)
    assert (one.n_values, one.median, one.mad) == (22, statistics.median(v), mad(v))
    assert one.score == pytest.approx(0.6745 * (60 - one.median) / one.mad)
    assert robust.significant_outliers(df.drop("median").limit(0)).count() == 0


def plain_trend(series):
    s = sorted(series.items())
    pairs = [(a, b) for k, a in enumerate(s) for b in s[k + 1:]]
    slope = statistics.median((b[1] - a[1]) / (b[0] - a[0]) for a, b in pairs)
    rises = sum((b[1] > a[1]) - (b[1] < a[1]) for a, b in pairs)
    n, counts = len(s), {v: list(series.values()).count(v) for v in series.values()}
    var = (n * (n - 1) * (2 * n + 5) - sum(t * (t - 1) * (2 * t + 5) for t in counts.values())) / 18
    return n, slope, rises, 0.0 if rises == 0 else (rises - (1 if rises > 0 else -1)) / var ** 0.5


@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(1900, 1960), st.one_of(st.none(), st.integers(-4, 4).map(lambda v: v / 2))),
                max_size=40, unique_by=lambda t: t[:2]))
@settings(max_examples=25, deadline=None)
def test_trends_against_all_pairs(spark, rows):
    got = {r.STATION: r for r in trends.station_trends(spark.createDataFrame(rows, "STATION string, YEAR int, avg_temp double")).collect()}
    want = {}
    for s in "ab":
        series = {y: v for k, y, v in rows if k == s and v is not None}
        if len(series) >= 3:
            want[s] = (series, plain_trend(series))
    assert set(got) == set(want)
    for s, (series, (n, slope, rises, z)) in want.items():
        r = got[s]
        assert (r.n_years, r.first_year, r.last_year, r.mk_s) == (n, min(series), max(series), rises)
        assert r.slope == pytest.approx(slope) and r.mk_z == pytest.approx(z)


def test_trend_of_many_years(spark):
    """The longest series a calendar gives: one array per site, pairs inside it."""
    rng = random.Random(1)
    series = {y: y * 0.01 + rng.gauss(0, 1) for y in range(1763, 2024)}
    rows = [(f"S{k}", y, v) for k in range(40) for y, v in series.items()]
    got = trends.station_trends(spark.createDataFrame(rows, "STATION string, YEAR int, avg_temp double")).collect()
    n, slope, rises, z = plain_trend(series)
    assert len(got) == 40 and all(r.mk_s == rises and r.slope == pytest.approx(slope) and r.mk_z == pytest.approx(z) for r in got)


def test_batch_counts_without_a_job(spark, tmp_path):
    raw = make_csv_dir(tmp_path)
    (raw / "e.csv").write_text("STATION,DATE,TAVG\ne,2000-01,1.5\ne,2000-02\ne,2000-03,999\ne,2000-04,-999,7\n")
    out = run_batch(spark, station_list(tmp_path), str(raw), str(tmp_path / "out"))
    table = snapshots.read_table(spark, out.base, "raw")
    report = {r.reason: r["count"] for r in clean.outlier_report(table).groupBy("reason").count().collect()}
    ragged = readings.read_readings(spark, str(raw), file_pattern="*.csv", flag_ragged=True).filter("ragged").count()
    assert out.counts == {
        "rows": table.count(), "ragged": ragged, "missing": table.filter("TAVG is null").count(), "low": report.get("low", 0),
        "high": report.get("high", 0), "kept": clean.clean_count(clean.clean_readings(table)).first().n}
    assert ragged >= 2 and report["low"] >= 1 and report["high"] >= 1
    assert "ragged" not in table.columns


def test_counts_take_no_job_of_their_own(spark, tmp_path):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1.0,), (None,), (500.0,)], "TAVG double")
    tracker = spark.sparkContext.statusTracker()
    seen = Observation("seen")
    spark.sparkContext.setJobGroup("observed", "")
    df.observe(seen, *clean.cleaning_counts()).write.parquet(str(tmp_path / "t"))
    with_counts = len(tracker.getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("plain", "")
    df.write.parquet(str(tmp_path / "u"))
    assert seen.get == {"rows": 3, "missing": 1, "low": 0, "high": 1, "kept": 1}
    assert with_counts == len(tracker.getJobIdsForGroup("plain"))
    spark.sparkContext.setJobGroup("", "")
