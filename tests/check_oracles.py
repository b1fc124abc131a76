"""Run registered queries and their SQL twins side by side: check_oracles.py [sf] [names...]."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs between two results, row order aside; None if nothing does."""
    got, want = canonical(got), canonical(want)
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for column in got.columns:
        if str(want[column].dtype) == "Int64" and got[column].dtype.kind == "f":
            got[column] = got[column].astype("Int64")  # whole numbers with NULLs among them
        if got[column].dtype.kind != want[column].dtype.kind:
            return f"{column}: {got[column].dtype} != {want[column].dtype}"
        same = (got[column] == want[column]) | (got[column].isna() & want[column].isna())
        if not same.all():
            at = (~same).idxmax()
            return (
                f"{column}: {(~same).sum()} differ, row {at}:\n"
                f"{got.loc[at].to_dict()}\n{want.loc[at].to_dict()}"
            )[:1500]
    return None


def main() -> int:
    from tests.conftest import new_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(contract.queries())
    spark, con = new_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        got = contract.queries()[name](spark, sf_dir).toPandas()
        middle = time.time()
        if name not in contract.oracle_sql():
            print(f"{name}: {len(got)} rows, no oracle, {middle - start:.1f} s", flush=True)
            continue
        want = con.execute(contract.oracle_sql()[name]).df()
        problem = difference(got, want)
        bad += problem is not None
        print(
            f"{name}: {problem or 'equal'}, {len(got)} rows,"
            f" {middle - start:.1f} s, oracle {time.time() - middle:.1f} s",
            flush=True,
        )
    return bad


if __name__ == "__main__":
    sys.exit(main())
