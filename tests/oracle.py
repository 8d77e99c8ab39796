"""Runs queries and their SQL side by side: python tests/oracle.py [name...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd


def frame(x: pd.DataFrame) -> pd.DataFrame:
    x = x[sorted(x.columns)].copy()
    for c in x.columns:
        if pd.api.types.is_datetime64_any_dtype(x[c]):
            x[c] = x[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_bool_dtype(x[c]):
            x[c] = x[c].astype(str)
        elif pd.api.types.is_numeric_dtype(x[c]):
            x[c] = x[c].astype(float).map(lambda v: "null" if pd.isna(v) else repr(v + 0.0))
        else:
            x[c] = x[c].map(lambda v: "null" if v is None or v is pd.NaT or v != v else str(v))
    return x.sort_values(list(x.columns)).reset_index(drop=True)


def compare(spark, name: str, sf_dir: str) -> str:
    import __spark_entry__ as e

    got = e.queries()[name](spark, sf_dir).toPandas()
    if name not in e.oracle_sql():
        return f"rows {len(got)}"
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    want = con.execute(e.oracle_sql()[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} {sorted(want.columns)}"
    a, b = frame(got), frame(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} {len(b)}"
    bad = [c for c in a.columns if not a[c].equals(b[c])]
    if bad:
        at = (a != b).any(axis=1)
        return f"DIFFER {bad} in {at.sum()} of {len(a)}\n{a[at].head(3)}\n{b[at].head(3)}"
    return f"equal {len(a)}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    import __spark_entry__ as e

    for n in sys.argv[1:] or [q for q in e.queries() if not q.startswith(("op", "pipeline"))]:
        t = time.time()
        try:
            said = compare(s, n, "/root/testdata/sf0.01")
        except Exception as x:
            said = f"ERROR {type(x).__name__} {str(x)[:500]}"
        print(f"{n} {time.time() - t:.1f}s {said}", flush=True)
