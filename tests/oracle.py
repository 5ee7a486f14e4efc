"""Compare registered queries with their SQL oracles: ``python tests/oracle.py [sf_dir] [names...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_rows(sf_dir, sql):
    """Column names and sorted rows of an oracle."""
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = db.sql(sql)
    return _sorted(result.columns, result.fetchall())


def spark_rows(result):
    return _sorted(result.columns, [tuple(row) for row in result.collect()])


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(rows, key=repr)


def same(left, right):
    return left[0] == right[0] and len(left[1]) == len(right[1]) and all(
        all(_equal(a, b) for a, b in zip(x, y)) for x, y in zip(left[1], right[1])
    )


def _equal(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return type(a) is type(b) and a == b


def main():
    root = str(Path(__file__).resolve().parent.parent)
    sys.path.insert(0, root)
    import __spark_entry__ as registry
    from shoptrail.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.queries())
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles = registry.oracle_sql()
    bad = []
    for name in names:
        begun = time.time()
        try:
            got = spark_rows(registry.queries()[name](spark, sf_dir))
            want = oracle_rows(sf_dir, oracles[name])
            ok = same(got, want)
            note = f"{len(got[1])} rows"
            if not ok:
                note += f" want {len(want[1])}; {got[0]} {want[0]}; {got[1][:2]} {want[1][:2]}"
        except Exception as error:  # report and go on with the next query
            ok, note = False, str(error)[:1500]
        bad += [] if ok else [name]
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begun:.2f}s {note}", flush=True)
    print("all equal" if not bad else f"not equal: {bad}")


if __name__ == "__main__":
    main()
