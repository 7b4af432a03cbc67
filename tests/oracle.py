"""Run registered queries against their SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if v != v else v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


KINDS = {
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "HUGEINT": "hugeint", "DOUBLE": "float", "FLOAT": "float",
    "VARCHAR": "str", "BOOLEAN": "bool", "bigint": "int", "int": "int", "double": "float", "float": "float",
    "string": "str", "boolean": "bool",
}


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    order = sorted(spark_df.columns)
    kinds = dict(spark_df.dtypes)
    got = [tuple(plain(v) for v in row) for row in spark_df.select(*order).collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    if sorted(names) != order:
        return f"columns {order} vs {sorted(names)}"
    at = [names.index(c) for c in order]
    want = [tuple(plain(row[i]) for i in at) for row in cur.fetchall()]
    for c in order:
        a, b = KINDS.get(kinds[c], kinds[c]), KINDS.get(types[c], types[c])
        if a in ("int", "float", "str", "bool") and a != b:
            return f"type of {c}: {kinds[c]} vs {types[c]}"
    if Counter(got) != Counter(want):
        extra, lack = Counter(got) - Counter(want), Counter(want) - Counter(got)
        return f"{len(got)} vs {len(want)} rows, cols {order}\n  spark only {list(extra)[:3]}\n  sql only   {list(lack)[:3]}"
    return None if want else "EMPTY"


def main() -> None:
    import __spark_entry__ as entry
    from chartloom.session import local_session

    sf = "/root/testdata/sf0.01"
    args = sys.argv[1:]
    if args and args[0].startswith("/"):
        sf = args.pop(0)
    spark = local_session()
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        t = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                res = compare(df, con, oracles[name]) or "ok"
            else:
                res = f"rows only: {len(df.collect())}"
        except Exception as e:  # report and go on
            res = f"{type(e).__name__}: {str(e)[:900]}"
        bad += not (res == "ok" or res.startswith("rows only"))
        print(f"{name:28s} {time.time() - t:6.2f}s {res}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
