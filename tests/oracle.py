"""Run a registered query and its SQL side by side. As a script: ``python tests/oracle.py SF [names]``."""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, run, sql: str) -> tuple[int, list[str]]:
    """Rows seen and the differences found; none if both sides agree."""
    df = run(spark, sf_dir)
    faults = []
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return 0, [f"columns {sorted(df.columns)} / {sorted(relation.columns)}"]
    names = sorted(df.columns)
    mine = Counter(map(tuple, df.select(*[f"`{n}`" for n in names]).collect()))
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    for label, rows in (("only here", mine - theirs), ("only there", theirs - mine)):
        if rows:
            faults.append(f"{label}: {sum(rows.values())} rows, e.g. {list(rows)[:2]}")
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    want = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if kind in want and kinds[name] != want[kind]:
            faults.append(f"type of {name}: {kind} / {kinds[name]}")
    return sum(mine.values()), faults


def main() -> None:
    import __spark_entry__ as entry
    from oreflow.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                 "spark.checkpoint.dir": "/tmp/oracle-work", "spark.sql.warehouse.dir": "/tmp/oracle-warehouse"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        if name not in oracles:
            print(f"none {name}")
            continue
        try:
            rows, faults = compare(spark, con, sf_dir, queries[name], oracles[name])
        except Exception as error:  # report and go on with the next query
            rows, faults = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
            if len(sys.argv) == 3:
                traceback.print_exc()
        bad += bool(faults)
        print(f"{'FAIL' if faults else 'ok  '} {name} rows={rows} {time.time() - start:.2f}s", *faults, sep="\n     ", flush=True)
    print(f"{bad} of {len(queries)} differ")


if __name__ == "__main__":
    main()
