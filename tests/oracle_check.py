"""Run registered queries next to their SQL and compare rows, types and values.

python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SAME_TYPE = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; nothing if names, types and the bags of rows are equal."""
    result = con.sql(sql)
    theirs = dict(zip(result.columns, (SAME_TYPE.get(str(t), str(t)) for t in result.types)))
    ours = dict(df.dtypes)
    if ours != theirs:
        return [f"columns {sorted(ours.items())} against {sorted(theirs.items())}"]
    order = sorted(ours)
    mine = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    want = sorted(con.sql(f"SELECT {', '.join(order)} FROM ({sql}) q").fetchall(), key=repr)
    if mine == want:
        return []
    missing, extra = [r for r in want if r not in set(mine)], [r for r in mine if r not in set(want)]
    return [f"rows {len(mine)} against {len(want)}", f"missing {missing[:3]}", f"extra {extra[:3]}"]


def main(sf_dir: str = "/root/testdata/sf0.01", *chosen: str) -> int:
    import __spark_entry__ as entry
    from lotwise.session import local_session

    spark = local_session()
    con = connect(sf_dir)
    sql, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            found = differences(df, con, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:
            found = [str(error)[:1500]]
        failed += bool(found)
        print(f"{name:20} {time.perf_counter() - start:6.2f}s {'; '.join(found) or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
