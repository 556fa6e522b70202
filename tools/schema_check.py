"""Compare result column types of each registered query: Spark vs DuckDB oracle."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from govlake.plans import REGISTRY  # noqa: E402
from govlake.plans.standins import TABLES  # noqa: E402
from govlake.session import build_session  # noqa: E402

SPARK_CLASS = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "float", "float": "float",
               "string": "str", "date": "date", "timestamp": "ts", "timestamp_ntz": "ts", "boolean": "bool"}
DUCK_CLASS = {"BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "SMALLINT": "int", "DOUBLE": "float", "FLOAT": "float",
              "VARCHAR": "str", "DATE": "date", "TIMESTAMP": "ts", "BOOLEAN": "bool", "UBIGINT": "int"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("schema-check")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, q in REGISTRY.items():
        if not q.sql:
            continue
        s = dict(q.fn(spark, sf).dtypes)
        rel = con.sql(q.sql)
        d = dict(zip(rel.columns, [str(t) for t in rel.types]))
        diffs = []
        for c, st in s.items():
            dt = d.get(c, "?")
            sc = SPARK_CLASS.get(st, st)
            dc = DUCK_CLASS.get(dt, "decimal" if dt.startswith("DECIMAL") else dt)
            exact = (st, dt) in {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"),
                                 ("date", "DATE"), ("boolean", "BOOLEAN"), ("timestamp_ntz", "TIMESTAMP"),
                                 ("timestamp", "TIMESTAMP"), ("smallint", "SMALLINT")}
            if not exact:
                diffs.append(f"{c}: spark={st} duck={dt}{'' if sc == dc else '  <-- CLASS'}")
        if diffs:
            print(name, "\n   " + "\n   ".join(diffs))


if __name__ == "__main__":
    main()
