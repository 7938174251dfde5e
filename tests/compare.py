"""Runs queries in Spark and their oracles in DuckDB and compares rows: compare.py SF_DIR [NAME...]"""

import os
import sys
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, Decimal):
        return float(v)
    return v


def oracle_rows(sql: str, sf_dir: str):
    import duckdb

    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p if p.is_file() else f'{p}/*.parquet'}'")
    got = c.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in got.fetchall()), key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    for name in names or e.oracle_sql():
        try:
            want, got = oracle_rows(e.oracle_sql()[name], sf_dir), spark_rows(e.queries()[name](spark, sf_dir))
            same = want == got
            print("ok " if same else "BAD", name, len(got[1]), flush=True)
            if not same:
                bad += 1
                print("  ", want[0], got[0], len(want[1]), len(got[1]))
                print("  ", [x for x, y in zip(want[1], got[1]) if x != y][:2], [y for x, y in zip(want[1], got[1]) if x != y][:2])
        except Exception as x:  # noqa: BLE001
            bad += 1
            print("ERR", name, str(x)[:600].replace("\n", " "), flush=True)
    return bad


if __name__ == "__main__":
    code = main(sys.argv[1], sys.argv[2:])
    sys.stdout.flush()
    os._exit(bool(code))
