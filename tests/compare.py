"""Runs registered queries against their SQL on the given tables; also a command line tool."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark, con, sf_dir, name):
    """(seconds, row count, list of differences) of one query."""
    import __spark_entry__ as entry

    started = time.time()
    result = entry.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in result.collect()]
    seconds = time.time() - started
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        return seconds, len(got), []
    answer = con.execute(oracle)
    wanted_columns = [d[0] for d in answer.description]
    wanted = answer.fetchall()
    if sorted(result.columns) != sorted(wanted_columns):
        return seconds, len(got), [f"columns {result.columns} vs {wanted_columns}"]
    order = [wanted_columns.index(c) for c in result.columns]
    got, wanted = normal(got), normal([tuple(r[i] for i in order) for r in wanted])
    if got == wanted:
        return seconds, len(got), []
    missing = [r for r in wanted if r not in set(got)][:3]
    extra = [r for r in got if r not in set(wanted)][:3]
    return seconds, len(got), [f"rows {len(got)} vs {len(wanted)}", f"missing {missing}", f"extra {extra}"]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    connection = connect(folder)
    for query in sys.argv[2:] or entry.queries():
        try:
            seconds, n, wrong = differences(session, connection, folder, query)
            print(f"{'OK ' if not wrong else 'BAD'} {query} rows={n} {seconds:.2f}s", *wrong, sep="\n    " if wrong else " ", flush=True)
        except Exception as error:
            print(f"ERR {query}", str(error)[:900], flush=True)
