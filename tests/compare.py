"""Run registered queries beside their SQL and compare names, types and values."""

from __future__ import annotations

import collections
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _bag(rows):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return collections.Counter(tuple(plain(v) for v in row) for row in rows)


def difference(df, con, statement: str) -> str | None:
    """What differs, or None."""
    wanted = con.execute(f"DESCRIBE {statement}").fetchall()
    names = sorted(r[0] for r in wanted)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    sql_types = {r[0]: r[1] for r in wanted}
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != sql_types[name]:
            return f"type of {name}: {kind} != {sql_types[name]}"
    ours = _bag(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    listed = ", ".join(f'"{n}"' for n in names)
    theirs = _bag(con.execute(f"SELECT {listed} FROM ({statement}) AS q").fetchall())
    if ours == theirs:
        return None
    extra, lacking = ours - theirs, theirs - ours
    return f"{sum(ours.values())} rows against {sum(theirs.values())}; extra {list(extra)[:3]}; lacking {list(lacking)[:3]}"


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as contract
    from seriesflow.session import local_session

    spark, con, bad = local_session(8), connect(sf_dir), 0
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(query(spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001 - reported
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
