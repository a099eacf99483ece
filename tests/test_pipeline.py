"""End-to-end batch job and incremental streaming ingest on fixture files."""

import pytest

from isotherm.operators import clean, metrics
from isotherm.plans.batch import run_batch
from isotherm.sources import readings, snapshots, store
from isotherm.streaming import start_incremental_ingest

from .test_sources import make_csv_dir


def station_list(tmp_path):
    p = tmp_path / "stations.txt"
    p.write_text(
        "a  10.0  20.0  5.0  ALPHA\n"
        "b  -5.0  30.0  1.0  BETA GSN 123\n"
        "c  50.0  14.0  2.0  GAMMA\n"
        "d  1.0  2.0  3.0  DELTA\n"
        "e  0.0  0.0  0.0  NO FILE\n"
    )
    return str(p)


def test_run_batch(spark, tmp_path):
    raw_dir = make_csv_dir(tmp_path)
    (raw_dir / "stray.csv").write_text("STATION,DATE,TAVG\nZZ,2001-01,30.0\n")  # not in the list
    (raw_dir / "bare.csv").write_text("Q,2001-01,30.0\n")
    regions = spark.createDataFrame(
        [("NORTH", 0.0, 90.0, -180.0, 180.0)], "country string, lat_min double, lat_max double, "
                                               "lon_min double, lon_max double")
    out = run_batch(spark, station_list(tmp_path), str(raw_dir), str(tmp_path / "out"),
                    country_regions=regions)
    assert set(out.written) == {"stations", "raw", "headerless_files", "outlier_report", "clean", "seasonal_avg",
                                "station_datapoints", "yearly_means", "year_change", "temp_change_matrix",
                                "precip_change_matrix", "missing_stations", "station_country"}
    read = lambda name: spark.read.parquet(out.path(name))
    expected_raw = readings.read_readings(spark, str(raw_dir / "[a-d].csv"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(read("raw")) == rows(expected_raw)
    assert rows(read("outlier_report")) == rows(clean.outlier_report(expected_raw))
    assert [r.source_file.rsplit("/", 1)[1] for r in read("headerless_files").collect()] == ["bare.csv"]
    assert read("stations").count() == 5
    expected_clean = clean.clean_readings(expected_raw)
    exported = store.read_year_ranges(spark, out.path("clean"))
    assert rows(exported.select("STATION", "DATE", "year_range")) == rows(
        store.with_year_range(expected_clean).select("STATION", "DATE", "year_range"))
    assert rows(read("yearly_means")) == rows(metrics.global_year_means(metrics.station_year_means(expected_clean)))
    got_clean = store.read_clean_store(spark, out.path("clean")).drop("year_range")
    assert sorted(map(tuple, got_clean.collect())) == sorted(map(tuple, expected_clean.select(*got_clean.columns).collect()))
    seasonal = spark.read.parquet(out.path("seasonal_avg"))
    assert sorted(map(tuple, seasonal.collect())) == sorted(map(tuple, metrics.seasonal_avg(expected_clean).collect()))
    missing = spark.read.parquet(out.path("missing_stations"))
    assert [r.station_id for r in missing.collect()] == ["e"]
    countries = {r.station_id: r.country for r in spark.read.parquet(out.path("station_country")).collect()}
    assert countries == {"a": "NORTH", "b": None, "c": "NORTH", "d": "NORTH", "e": "NORTH"}
    matrix = read("temp_change_matrix")
    assert len(matrix.columns) == 72 and matrix.columns[1] == "t_minus20" and matrix.columns[-1] == "t50"


def test_run_batch_on_a_sample(spark, tmp_path):
    raw_dir = make_csv_dir(tmp_path)
    ranges = spark.createDataFrame([(0, 1), (3, 100)], "start long, end long")  # a, d, e
    out = run_batch(spark, station_list(tmp_path), str(raw_dir), str(tmp_path / "sampled"), sample_ranges=ranges)
    assert sorted(r.station_id for r in spark.read.parquet(out.path("stations")).collect()) == ["a", "d", "e"]
    expected = readings.read_readings(spark, str(raw_dir / "[ad].csv"))
    got = spark.read.parquet(out.path("raw"))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert [r.station_id for r in spark.read.parquet(out.path("missing_stations")).collect()] == ["e"]


def test_incremental_ingest_matches_batch_and_is_idempotent(spark, tmp_path):
    raw_dir = make_csv_dir(tmp_path)
    store_path = str(tmp_path / "store")
    ckpt = str(tmp_path / "ckpt")
    q = start_incremental_ingest(spark, str(raw_dir), store_path, ckpt, files_per_batch=1)
    q.awaitTermination()
    got = spark.read.parquet(store_path)
    # one file per batch; files c and d hold no valid temperature, so their batches are empty
    assert sorted(p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("batch=")) == [
        "batch=0", "batch=1", "batch=2", "batch=3"]
    assert got.select("batch").distinct().count() == 2
    cols = ["STATION", "DATE", "LATITUDE", "LONGITUDE", "TAVG", "PRCP", "YEAR", "MONTH", "SEASON"]
    expected = clean.clean_readings(readings.read_readings(spark, str(raw_dir / "*.csv"))).select(*cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, expected.collect()))
    # Running again with the same checkpoint processes nothing new.
    q2 = start_incremental_ingest(spark, str(raw_dir), store_path, ckpt, files_per_batch=1)
    q2.awaitTermination()
    assert spark.read.parquet(store_path).count() == expected.count()
    assert "batch" not in store.read_clean_store(spark, store_path).columns
    # A new checkpoint would start at batch 0 again and replace what is there.
    with pytest.raises(ValueError):
        start_incremental_ingest(spark, str(raw_dir), store_path, str(tmp_path / "other"))


def test_command_line_entry(spark, tmp_path):
    from isotherm.plans.batch import main
    from isotherm.session import CLUSTER_CONF

    raw_dir = make_csv_dir(tmp_path)
    out = tmp_path / "cli"
    # The entry point applies the cluster settings to the (shared) session: restore them after.
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        main(["--stations", station_list(tmp_path), "--readings", str(raw_dir), "--output", str(out)])
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert snapshots.read_table(spark, str(out), "seasonal_avg").count() > 0
    assert [r.station_id for r in snapshots.read_table(spark, str(out), "missing_stations").collect()] == ["e"]


def test_streamed_files_of_any_size(spark, tmp_path):
    """Files beyond the whole-file size are read line by line, and give the same rows."""
    raw_dir = make_csv_dir(tmp_path)
    lines = [f"big,{1990 + k // 12}-{k % 12 + 1:02d},{k % 40}.5" for k in range(400)]
    (raw_dir / "big.csv").write_text("STATION,DATE,TAVG\n" + "\n".join(lines) + "\n")
    for name, size in (("whole", 1 << 20), ("lines", 0), ("both", 1000)):
        start_incremental_ingest(spark, str(raw_dir), str(tmp_path / name), str(tmp_path / f"{name}-ckpt"), files_per_batch=2,
                                 whole_file_bytes=size).awaitTermination()
    expected = clean.clean_readings(readings.read_readings(spark, str(raw_dir / "*.csv")))
    for name in ("whole", "lines", "both"):
        got = store.read_clean_store(spark, str(tmp_path / name)).select(*expected.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_queries_without_the_libraries_of_the_subpackage(tmp_path):
    """A library that the optional subpackage needs may be missing: the other queries stay."""
    import os
    import subprocess
    import sys

    (tmp_path / "tokenizers.py").write_text("raise ImportError('not here', name='tokenizers')")
    (tmp_path / "public_tokenizers.py").write_text("raise ImportError('not here', name='public_tokenizers')")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; "
            "assert 'seasonal_avg' in e.queries() and not [k for k in e.queries() if k.startswith('op')]; print('fine')")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"})
    assert done.stdout.strip() == "fine", done.stderr
