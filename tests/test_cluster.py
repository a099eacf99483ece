"""Queries that write to the shared folder, on a cluster whose ``spark.checkpoint.dir`` is a path without a scheme."""

import json
import os
import subprocess
import sys

import pytest

from .conftest import ROOT, SF_SMALL

QUERIES = ["block_sample", "missing_stations", "readings_ingest", "refreshed_year_means", "region_summary_store",
           "replaced_range", "year_range_export", "station_parse", "quoted_ingest", "headerless_files",
           "listed_ingest", "refreshed_datapoints", "sampled_ingest"]


def _on_cluster(tmp, checkpoints: str, names: list[str]) -> dict:
    (tmp / "cwd").mkdir()
    run = subprocess.run([sys.executable, os.path.join(ROOT, "tests", "cluster_run.py"), checkpoints, SF_SMALL, str(tmp), *names],
                         cwd=tmp / "cwd", capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-2000:]
    return json.loads(run.stdout.splitlines()[-1])


@pytest.fixture(scope="module")
def on_cluster(tmp_path_factory):
    tmp = tmp_path_factory.mktemp("cluster")
    return _on_cluster(tmp, str(tmp / "checkpoints"), QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_a_cluster_with_a_plain_checkpoint_path(on_cluster, name):
    ok, message = on_cluster[name]
    assert ok, message


def test_a_folder_that_is_not_shared_is_refused(tmp_path):
    # Each process has a folder of its own there.
    ok, message = _on_cluster(tmp_path, "/proc/self/cwd/own", ["block_sample"])["block_sample"]
    assert not ok and "is not shared" in message, message
