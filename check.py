"""Compare every registered query with its check SQL in DuckDB: ``python check.py [folder] [name ...]``."""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from tickloom.plans import CHECKS, QUERIES
from tickloom.session import builder


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a stated order, values as exact text."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = df[c].astype("datetime64[us]")
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v != v else repr(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs between two results, or None."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    types = [
        (c, str(ours[c].dtype), str(theirs[c].dtype))
        for c in ours.columns
        if len(ours) and ours[c].dtype.kind != theirs[c].dtype.kind
    ]
    if types:
        return f"types {types}"
    a, b = normalise(ours), normalise(theirs)
    unequal = ~((a == b) | (a.isna() & b.isna())).all(axis=1)
    if unequal.any():
        at = unequal.idxmax()
        return f"{int(unequal.sum())} rows differ, first {a.loc[at].to_dict()} vs {b.loc[at].to_dict()}"
    return None


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (
        builder("check", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
        .master("local[8]").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            ours = QUERIES[name](spark, folder).toPandas()
            if name in CHECKS:
                problem = difference(ours, con.execute(CHECKS[name]).df())
            else:
                problem = None if len(ours) else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        verdict = "ok" if problem is None else "FAIL " + problem
        print(f"{name:28} {time.time() - start:6.2f}s {len(ours) if problem is None else '':>8} {verdict}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
