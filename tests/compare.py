"""Run catalogue queries on Spark and their SQL on DuckDB, and compare rows as sets with counts."""

from __future__ import annotations

import decimal
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences; an empty list means equal names, kinds and values."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got_cols = df.columns
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(got_cols)} != {sorted(want_cols)}"]
    problems = []
    kinds = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if want_types[f.name] not in kinds.get(kind, {want_types[f.name]}):
            problems.append(f"type of {f.name}: {kind} vs {want_types[f.name]}")
    order = sorted(got_cols)
    got_rows = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    at = {c: i for i, c in enumerate(want_cols)}
    want_rows = Counter(tuple(_plain(r[at[c]]) for c in order) for r in want)
    if got_rows != want_rows:
        extra, lost = got_rows - want_rows, want_rows - got_rows
        problems.append(
            f"rows {sum(got_rows.values())} vs {sum(want_rows.values())}; only Spark {sum(extra.values())}: "
            f"{[str(x)[:300] for x in list(extra)[:2]]}; only SQL {sum(lost.values())}: {[str(x)[:300] for x in list(lost)[:2]]}"
        )
    return problems


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    folder = tempfile.mkdtemp(prefix="compare-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            result = compare(df, con, sqls[name]) if name in sqls else [f"rows only: {len(df.collect())}"]
        except Exception as e:
            result = [f"{type(e).__name__}: {str(e)[:1500]}"]
        print(f"{'ok  ' if not result else '----'} {name} {time.time() - start:.1f}s {' | '.join(result)}", flush=True)


if __name__ == "__main__":
    main()
