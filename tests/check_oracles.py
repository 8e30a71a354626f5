"""Compare registered queries with their SQL: ``python tests/check_oracles.py sf_dir [names]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from recordloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(con, df, sql):
    """None when equal, else what differs."""
    got = df.collect()
    result = con.execute(sql)
    names = [item[0] for item in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} != {names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    left, right = rows_of(df.columns, got), rows_of(names, want)
    for a, b in zip(left, right):
        if [(type(x), x) for x in a] != [(type(x), x) for x in b]:
            return f"{a} != {b}"
    return None


def main():
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            if name in oracles:
                problem = compare(con, df, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
