"""Quoted line breaks, chosen files, snapshot tables and the incremental refresh."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from isotherm.operators import clean, metrics, partials
from isotherm.plans import refresh
from isotherm.plans.batch import run_batch
from isotherm.sources import listing, readings, snapshots, store

from .test_pipeline import station_list
from .test_sources import make_csv_dir

NAMED = StructType().add("STATION", StringType()).add("DATE", StringType()).add("NAME", StringType()).add("TAVG", DoubleType())


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def split_bytes(spark):
    """Sets the size of file splits, as if files were cut into many."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def to(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], 0)

    yield to
    for k in keys:
        spark.conf.unset(k)


# ---------------------------------------------------------------- quoted line breaks

def quoted(value):
    return '"' + value.replace('"', '""') + '"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_in_any_splits(spark, tmp_path, split_bytes, end):
    names = ["plain", 'a "b"', "x\n, y", "\n", "p\n\n2000-04,q", '"\n"', "", "long " * 9 + "\n" + "more " * 20, ",\n" * 12]
    folder = tmp_path / "csv"
    folder.mkdir()
    expected = []
    for f in range(3):
        lines = ["STATION,DATE,NAME,TAVG" if f < 2 else "TAVG,DATE,NAME,STATION"]
        for k, name in enumerate(names * 2):
            fields = [f"S{f}", f"200{f}-{k % 12 + 1:02d}", quoted(name.replace("\n", end)), str(k)]
            lines += [",".join(fields if f < 2 else fields[::-1][0:1] + fields[1:3] + fields[0:1]), ""][:1 + k % 2]
            expected.append((f"S{f}", f"200{f}-{k % 12 + 1:02d}", name or None, float(k)))
        (folder / f"{f}.csv").write_bytes(end.join(lines).encode())
    # The quotes of this file do not pair up: its lines are taken as they are.
    (folder / "stray.csv").write_bytes(b'STATION,DATE,NAME,TAVG\nZ,2001-01,5" pipe,3\nZ,2001-02,y,4\n')
    expected += [("Z", "2001-01", '5" pipe', 3.0), ("Z", "2001-02", "y", 4.0)]
    read = lambda whole: sorted(map(tuple, readings.read_readings(
        spark, str(folder), NAMED, file_pattern="*.csv", whole_files=whole, quoted_breaks=True).collect()), key=str)
    assert read(True) == sorted(expected, key=str)
    for size in (10**6, 401, 64, 17, 5):
        split_bytes(size)
        assert read(False) == sorted(expected, key=str), size


@pytest.mark.parametrize("bits", [0, 1, 3, 15])
def test_records_across_chunks_of_a_block(spark, monkeypatch, bits):
    """All lines in one block: windows hold a chunk of it, and records go across chunks."""
    monkeypatch.setattr(readings, "CHUNK_BITS", bits, raising=False)
    fields = ["a", '"b\nc"', '"' + "\n" * 9 + '"', "d", '"e', "f", '"\n""g', "", '"\n"\n"\n"', "h"]
    content = "\n".join(fields)
    data = spark.createDataFrame([("p", 0, k, line) for k, line in enumerate(content.split("\n"))],
                                 "_path string, _block long, _number long, _line string")
    joined = readings.joined_records(data)
    expected, inside = [], False
    for line in content.split("\n"):
        expected = [*expected[:-1], f"{expected[-1]}\n{line}"] if inside else [*expected, line]
        inside ^= line.count('"') % 2 == 1
    assert not inside and [r._line for r in joined.orderBy("_number").collect()] == expected
    plan = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
    over_lines = [x for x in plan.splitlines() if "Window [" in x and ("_number#" in x or "_record#" in x)]
    assert over_lines and all("_chunk#" in x for x in over_lines)


def test_quoted_lines_are_packed_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    """The shuffles hold rows by chunk and by record across chunks, not by line."""
    records = 5_000
    (tmp_path / "q.csv").write_text("STATION,DATE,NAME,TAVG\n" + "".join(f'S,2001-01,"a\n\nb ""{k}""",{k}\n' for k in range(records)))
    monkeypatch.setattr(readings, "CHUNK_BITS", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = readings.read_readings(spark, str(tmp_path), NAMED, file_pattern="*.csv", whole_files=False, quoted_breaks=True)
        got = found.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r.NAME, r.TAVG) for r in got) == sorted((f'a\n\nb "{k}"', float(k)) for k in range(records))

    def shuffled(plan):
        written = plan.metrics().get("shuffleRecordsWritten")
        children = plan.children()
        return (written.get().value() if written.isDefined() else 0) + sum(shuffled(children.apply(i)) for i in range(children.size()))

    assert 0 < shuffled(found._jdf.queryExecution().executedPlan()) < records / 4


@given(st.lists(st.text('a",\n', max_size=8), min_size=1, max_size=6))
@settings(max_examples=25, deadline=None)
def test_joined_records_follow_the_quotes(spark, texts):
    """Blocks of a line each: the parity of all quotes before a line decides."""
    content = "\n".join(texts)
    lines = content.split("\n")
    want, inside = [], False
    paired = content.count('"') % 2 == 0
    for line in lines:
        if inside and paired:
            want[-1] += "\n" + line
        else:
            want.append(line)
        inside ^= line.count('"') % 2 == 1
    data = spark.createDataFrame([("p", k // 2, k, line) for k, line in enumerate(lines)],
                                 "_path string, _block long, _number long, _line string")
    got = [r._line for r in readings.joined_records(data).orderBy("_block", "_number").collect()]
    assert got == want
    whole = [r for r in want if r]
    assert [r for r in spark.createDataFrame([(content,)], "c string").select(
        F.coalesce(readings._records(F.col("c")), F.lit(None)).alias("r")).first().r or whole] == whole


# ---------------------------------------------------------------- chosen files

def files_opened(spark, df):
    """Files that the scans of a frame read."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        counts = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
        return sum(c.get().value() for c in counts if c.isDefined())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.fixture()
def station_files(tmp_path):
    for k in range(12):
        (tmp_path / f"S'{k}.csv").write_text(f"STATION,DATE,NAME,TAVG\nS'{k},2001-0{k % 9 + 1},n,{k}\n")
    return str(tmp_path)


def test_only_chosen_files_are_opened(spark, station_files, monkeypatch):
    only = spark.createDataFrame([("S'1",), ("S'7",), ("S'7",), ("none",), (None,)], "station_id string")
    read = lambda **more: readings.read_readings(spark, station_files, NAMED, file_pattern="*.csv", only=only, **more)
    expected = rows(readings.read_readings(spark, station_files, NAMED, file_pattern="*.csv").filter(
        F.col("STATION").isin("S'1", "S'7")))
    assert len(expected) == 2
    for more in ({}, {"whole_files": True}, {"whole_files": False}):
        assert rows(read(**more)) == expected
    assert files_opened(spark, read(whole_files=True)) == 2
    assert files_opened(spark, read()) == 2
    none = readings.read_readings(spark, station_files, NAMED, file_pattern="*.csv", only=only.limit(0))
    assert none.count() == 0 and files_opened(spark, none) == 0
    # Beyond the bound the choice is a join: the same rows, from all files.
    monkeypatch.setattr(readings, "CHOSEN_IDS", 1)
    assert rows(read()) == expected and files_opened(spark, read(whole_files=True)) == 12


def test_only_chosen_folders_are_opened(spark, station_files, tmp_path, monkeypatch):
    path = str(tmp_path / "folders")
    readings.read_readings(spark, station_files, NAMED, file_pattern="*.csv").write.partitionBy("STATION").option(
        "header", True).csv(path)
    only = spark.createDataFrame([("S'1",), ("S'7",), ("none",)], "station_id string")
    read = lambda: readings.read_readings(spark, path, NAMED, file_pattern="*.csv", only=only, folder="STATION")
    assert sorted(r.TAVG for r in read().collect()) == [1.0, 7.0]
    assert files_opened(spark, read()) == 2
    monkeypatch.setattr(readings, "CHOSEN_IDS", 1)
    assert sorted(r.TAVG for r in read().collect()) == [1.0, 7.0]


def test_only_chosen_paths_are_opened(spark, station_files, monkeypatch):
    some = listing.file_details(spark, station_files, "*.csv").filter(F.col("path").rlike("7.csv|11.csv")).select("path")
    read = lambda: readings.read_readings(spark, station_files, NAMED, file_pattern="*.csv", only_paths=some)
    assert sorted(r.TAVG for r in read().collect()) == [7.0, 11.0]
    assert files_opened(spark, read()) == 2
    monkeypatch.setattr(readings, "CHOSEN_IDS", 0)
    assert sorted(r.TAVG for r in read().collect()) == [7.0, 11.0]


def test_sampled_ingest_opens_the_chosen_files(spark):
    from isotherm.plans import catalog

    from .conftest import SF_SMALL

    found = catalog.q_sampled_ingest(spark, SF_SMALL)
    stations = found.select("STATION").distinct().count()
    assert 0 < stations <= 6 and stations <= files_opened(spark, found) <= 6


# ---------------------------------------------------------------- snapshots

def test_snapshot_versions(spark, tmp_path):
    base = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        snapshots.read_table(spark, base, "t")
    frame = lambda n: spark.createDataFrame([(n, "x"), (n, None)], "v long, p string")
    first = snapshots.begin(spark, base)
    first.replace("t", frame(1))
    first.replace("u", frame(1).limit(0), "p")
    assert snapshots.versions(spark, base) == []  # staged rows are not seen
    assert first.commit() == 0
    old = snapshots.read_table(spark, base, "t")
    assert snapshots.read_table(spark, base, "u").schema == frame(1).schema and snapshots.read_table(spark, base, "u").count() == 0
    second = snapshots.begin(spark, base)
    second.replace("t", frame(2))
    assert {r.v for r in second.read("t").collect()} == {2}
    assert {r.v for r in snapshots.read_table(spark, base, "t").collect()} == {1}
    assert second.commit() == 1
    assert {r.v for r in snapshots.read_table(spark, base, "t").collect()} == {2}
    # A frame made before keeps its rows, and an older version can be read.
    assert {r.v for r in old.collect()} == {r.v for r in snapshots.read_table(spark, base, "t", 0).collect()} == {1}


def test_second_of_two_writers_is_refused(spark, tmp_path):
    base = str(tmp_path / "s")
    one, two = snapshots.begin(spark, base), snapshots.begin(spark, base)
    one.replace("t", spark.range(1))
    two.replace("t", spark.range(2))
    one.commit()
    with pytest.raises(snapshots.ConcurrentWrite):
        two.commit()
    assert snapshots.read_table(spark, base, "t").count() == 1
    assert os.listdir(tmp_path / "s" / "versions") and not [n for n in os.listdir(tmp_path / "s" / "versions") if n.endswith(".tmp")]


def test_failed_write_leaves_the_old_rows(spark, tmp_path):
    base = str(tmp_path / "s")
    work = snapshots.begin(spark, base)
    work.replace("t", spark.range(10))
    work.commit()
    failing = spark.range(0, 100, 1, 4).withColumn(
        "id", F.when(F.col("id") == 99, F.raise_error(F.lit("halfway")).cast("long")).otherwise(F.col("id")))
    again = snapshots.begin(spark, base)
    with pytest.raises(Exception, match="halfway"):
        again.replace("t", failing)
    assert snapshots.read_table(spark, base, "t").count() == 10


def stored_files(tmp_path, table):
    return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "s" / "data" / table).rglob("*.parquet")}


def test_one_year_range_is_replaced_alone(spark, tmp_path):
    base = str(tmp_path / "s")
    frame = spark.createDataFrame([(y, float(y % 7), float(y % 5), 1.0) for y in range(1790, 2023, 3)] + [(None, 0.0, 0.0, 2.0)],
                                  "YEAR int, LATITUDE double, LONGITUDE double, TAVG double")
    store.commit_clean_store(frame, base)
    before = stored_files(tmp_path, "clean")
    store.commit_year_ranges(frame.withColumn("TAVG", F.lit(9.0)), base, ["1851_1900", "1996_2005"])
    got = store.read_committed_store(spark, base)
    replaced = F.col("year_range").isin("1851_1900", "1996_2005")
    assert {r.TAVG for r in got.filter(replaced).collect()} == {9.0}
    assert rows(got.filter(~replaced)) == rows(store.read_committed_store(spark, base, 0).filter(~replaced))
    after = stored_files(tmp_path, "clean")
    assert before.items() <= after.items()
    assert {p.split("year_range=")[1][:9] for p in after.keys() - before.keys()} == {"1851_1900", "1996_2005"}
    # Only the folder of the range that is asked for is read.
    assert files_opened(spark, got.filter("year_range = '1996_2005'")) == len(
        [p for p in after.keys() - before.keys() if "1996_2005" in p])
    # A range without rows goes; the others stay.
    store.commit_year_ranges(frame.limit(0), base, ["1996_2005"])
    assert got.select("year_range").distinct().count() - 1 == store.read_committed_store(spark, base).select("year_range").distinct().count()


def test_partitions_outside_those_named_are_refused(spark, tmp_path):
    work = snapshots.begin(spark, str(tmp_path / "s"))
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, p string")
    work.replace("t", frame, "p")
    with pytest.raises(ValueError):
        work.replace_partitions("t", frame, "p", ["a"])
    with pytest.raises(ValueError):
        work.replace_partitions("t", frame.select("p"), "p")
    work.replace_partitions("t", frame.filter("p is null").withColumn("v", F.lit(7)), "p", [None])
    assert sorted(map(tuple, work.read("t").collect()), key=str) == [(1, "a"), (2, "b"), (7, None)]


def test_vacuum_keeps_what_versions_name(spark, tmp_path):
    base = str(tmp_path / "s")
    for n in range(4):
        work = snapshots.begin(spark, base)
        work.replace("t", spark.range(n + 1))
        work.commit()
    staged = snapshots.begin(spark, base)
    staged.replace("t", spark.range(99))
    assert snapshots.vacuum(spark, base, keep=2)  # versions 0 and 1; writes are too young
    assert len(list((tmp_path / "s" / "data" / "t").iterdir())) == 5
    snapshots.vacuum(spark, base, keep=2, older_than_seconds=-5)
    assert len(list((tmp_path / "s" / "data" / "t").iterdir())) == 2
    assert [snapshots.read_table(spark, base, "t", v).count() for v in snapshots.versions(spark, base)] == [3, 4]


def test_failed_batch_leaves_the_last_results(spark, tmp_path, monkeypatch):
    raw = make_csv_dir(tmp_path)
    out = str(tmp_path / "out")
    run_batch(spark, station_list(tmp_path), str(raw), out)
    before = {n: rows(snapshots.read_table(spark, out, n)) for n in ("raw", "seasonal_avg", "missing_stations")}
    for f in raw.glob("*.csv"):
        f.write_text("STATION,DATE,TAVG\nnew,2001-01,30.0\n")
    monkeypatch.setattr(listing, "missing_stations", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, station_list(tmp_path), str(raw), out)
    assert before == {n: rows(snapshots.read_table(spark, out, n)) for n in before}


# ---------------------------------------------------------------- incremental refresh

def write_site(folder, name, values, times=1):
    lines = [f"{name},{y}-{m:02d},1.0,2.0,{t},{p}" for y, m, t, p in values]
    (folder / f"{name}.csv").write_text("\n".join(["STATION,DATE,LATITUDE,LONGITUDE,TAVG,PRCP", *lines * times]) + "\n")


def full_run(spark, folder):
    cleaned = clean.clean_readings(readings.read_readings(spark, str(folder), file_pattern="*.csv"))
    by_site = metrics.station_year_means(cleaned)
    return (rows(metrics.seasonal_avg(cleaned)), rows(metrics.station_datapoints(cleaned)), rows(by_site),
            rows(metrics.global_year_means(by_site)))


def from_totals(spark, base):
    totals = refresh.totals(spark, base)
    by_site = partials.station_year_means_of(totals)
    return (rows(partials.seasonal_avg_of(totals)), rows(partials.station_datapoints_of(totals)), rows(by_site),
            rows(metrics.global_year_means(by_site)))


def test_refresh_equals_the_full_run(spark, tmp_path, monkeypatch):
    folder, base = tmp_path / "raw", str(tmp_path / "store")
    folder.mkdir()
    opened = []
    real = readings.chosen_paths
    monkeypatch.setattr(readings, "chosen_paths", lambda text, only, paths: (opened.append(sorted(
        p.rsplit("/", 1)[1] for p in paths)), real(text, only, paths))[1])
    same = [(2000, 1, 3.3, 1.1), (2000, 2, "", 4.0), (2001, 7, 99.0, ""), (2001, 7, 400, 1.0)]
    for k in range(6):
        write_site(folder, f"s{k}", [(2000 + k % 3, k % 12 + 1, 10.25 + k, 0.7 * k), *same])
    (folder / "empty.csv").write_text("no header here\n")
    done = refresh.refresh(spark, str(folder), base, buckets=4)
    assert (done.version, done.added, done.changed, done.removed) == (0, 7, 0, 0)
    assert from_totals(spark, base) == full_run(spark, folder)
    again = refresh.refresh(spark, str(folder), base, buckets=4)
    assert (again.version, again.added, again.changed, again.removed) == (None, 0, 0, 0)

    opened.clear()
    write_site(folder, "s1", [(1999, 5, -3.5, 2.0)])
    write_site(folder, "s8", same, times=3)
    (folder / "s2.csv").unlink()
    (folder / "empty.csv").write_text("STATION,DATE,TAVG\nbad,no date,1.5\n")
    done = refresh.refresh(spark, str(folder), base, buckets=4)
    assert (done.version, done.added, done.changed, done.removed) == (1, 1, 2, 1)
    assert {tuple(o) for o in opened} == {("empty.csv", "s1.csv", "s8.csv")}  # no other file is read
    assert from_totals(spark, base) == full_run(spark, folder)

    for f in folder.glob("*.csv"):
        f.unlink()
    write_site(folder, "last", same)
    refresh.refresh(spark, str(folder), base, buckets=4)
    assert from_totals(spark, base) == full_run(spark, folder)


def test_failed_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    folder, base = tmp_path / "raw", str(tmp_path / "store")
    folder.mkdir()
    write_site(folder, "a", [(2000, 1, 5.0, 1.0)])
    refresh.refresh(spark, str(folder), base)
    before = from_totals(spark, base)
    write_site(folder, "a", [(2000, 1, 7.0, 1.0), (2000, 2, 9.0, 1.0)])
    monkeypatch.setattr(snapshots.Transaction, "commit", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh.refresh(spark, str(folder), base)
    assert from_totals(spark, base) == before
    monkeypatch.undo()
    done = refresh.refresh(spark, str(folder), base)
    assert done.changed == 1 and from_totals(spark, base) == full_run(spark, folder)


@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(2000, 2001), st.integers(-2000, 5000)), max_size=30), st.integers(0, 30))
@settings(max_examples=10, deadline=None)
def test_sums_add_up_and_subtract(spark, data, cut):
    frame = lambda d: spark.createDataFrame([(s, y, "Summer", t / 100, None) for s, y, t in d],
                                            "STATION string, YEAR int, SEASON string, TAVG double, PRCP double")
    whole, part = partials.partial_sums(frame(data)), partials.partial_sums(frame(data[:cut]))
    rest = partials.merged_sums(whole.unionByName(partials.negated(part)))
    assert rows(rest) == rows(partials.partial_sums(frame(data[cut:])))
