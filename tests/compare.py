"""Run registered queries against their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and the SQL result; empty if nothing does."""
    result = con.execute(sql)
    names, kinds = [d[0] for d in result.description], [str(d[1]) for d in result.description]
    wanted = result.fetchall()
    found = [tuple(r) for r in df.collect()]
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    ours = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    theirs = dict(zip(names, kinds))
    for name, kind in df.dtypes:
        if ours.get(kind, kind) != theirs[name]:
            out.append(f"type of {name}: {kind} against {theirs[name]}")
    a, b = _rows(df.columns, found), _rows(names, wanted)
    if a != b:
        extra, missing = list((a - b).elements()), list((b - a).elements())
        out.append(f"{len(found)} rows against {len(wanted)}; {len(extra)} extra {extra[:2]}; {len(missing)} missing {missing[:2]}")
    return out


def main(sf_dir: str, only: list[str]) -> int:
    from fleetlens import catalog
    from fleetlens.session import build_session

    spark = build_session("compare", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), catalog.oracles(), 0
    for name, run in catalog.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems, note = differences(run(spark, sf_dir), con, oracles[name]), "equal"
            else:
                problems, note = [], f"{run(spark, sf_dir).count()} rows, no SQL"
        except Exception as e:  # report and go on with the next query
            problems, note = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        failed += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s {'; '.join(problems) or note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
