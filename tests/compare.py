"""Run registered queries against their SQL, strictly: names, types and values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


def spark_result(df):
    names = sorted(df.columns)
    types = {f.name: TYPE_NAMES[f.dataType.simpleString()] for f in df.schema}
    rows = [tuple(_norm(r[n]) for n in names) for r in df.collect()]
    return [(n, types[n]) for n in names], rows


def sql_result(con, sql):
    cur = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cur.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    return [described[i] for i in order], rows


def difference(df, con, sql):
    """None if equal, else a text."""
    schema, rows = spark_result(df)
    want_schema, want = sql_result(con, sql)
    if schema != want_schema:
        return f"schema {schema} != {want_schema}"
    if sorted(rows) != sorted(want):
        only, missing = sorted(set(rows) - set(want))[:2], sorted(set(want) - set(rows))[:2]
        return f"rows {len(rows)} != {len(want)} or values differ; only in Spark {only}; only in SQL {missing}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = difference(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'BAD '} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
