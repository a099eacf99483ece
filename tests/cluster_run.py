"""Run as a script: queries on a local cluster of two executors, each compared with its DuckDB oracle.

Arguments: the value of ``spark.checkpoint.dir``, a folder of tables, a scratch folder, names of queries. The last
line printed is JSON: ``[equal, message]`` by query.
"""

import importlib.util
import json
import os
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def main(checkpoints: str, sf_dir: str, scratch: str, *names: str) -> None:
    # Workers put their folders into Spark's home, so it is one of links here.
    home = Path(scratch, "home")
    (home / "work").mkdir(parents=True)
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    os.environ.update(SPARK_HOME=str(home), SPARK_SCALA_VERSION="2.13", SPARK_LOCAL_IP="127.0.0.1",
                      SPARK_LOCAL_DIRS=f"{scratch}/local", PYSPARK_PYTHON=sys.executable)
    sys.path.insert(0, str(ROOT))
    from pyspark.sql import SparkSession

    from isotherm.plans.catalog import ORACLE_SQL, QUERIES
    from tools.verify import compare, duckdb_connection

    spark = SparkSession.builder.master("local-cluster[2,2,1024]").config(map={
        "spark.executor.memory": "1024m", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": checkpoints}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, found = duckdb_connection(sf_dir), {}
    for name in names:
        try:
            found[name] = compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name])
        except Exception as exc:  # go on with the other queries
            found[name] = (False, f"{type(exc).__name__}: {str(exc)[:300]}")
    print(json.dumps(found), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
