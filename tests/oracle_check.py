"""Compare a query with its SQL counterpart; also runs as a script over all queries."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(df.columns)
    return df[columns].sort_values(columns, ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    got, want = _sorted(got), _sorted(want)
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got if got[c].dtype.kind != want[c].dtype.kind}
    if kinds:
        return f"types {kinds}"
    wrong = ~((got == want) | (got.isna() & want.isna())).all(axis=1)
    if wrong.any():
        i = wrong.idxmax()
        return f"{wrong.sum()} rows differ, such as {got.loc[i].to_dict()} instead of {want.loc[i].to_dict()}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from passagelake.plans.oracle import ORACLE
    from passagelake.plans.queries import QUERIES

    folder = f"/root/testdata/{sys.argv[1]}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        got = QUERIES[name](spark, folder).toPandas()
        middle = time.time()
        want = con.execute(ORACLE[name]).df() if name in ORACLE else None
        verdict = "rows only" if want is None else (difference(got, want) or "equal")
        print(f"{name}: {len(got)} rows, {middle - start:.2f}s, oracle {time.time() - middle:.2f}s: {verdict[:900]}", flush=True)
