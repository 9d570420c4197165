"""Compares registered queries with DuckDB: ``python -m checks.run [pattern] [sf_dir]``."""

from __future__ import annotations

import re
import sys
import time

import checks.cases  # noqa: F401
from checks.compare import connection, difference
from checks.registry import ORACLES, QUERIES
from wakeline.session import build_session


def main() -> int:
    pattern = re.compile(sys.argv[1] if len(sys.argv) > 1 else ".")
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session(
        "wakeline-checks", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if not pattern.search(name):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, query, ORACLES[name], sf_dir, con)
                word = "ok"
            else:
                n = query(spark, sf_dir).toArrow().num_rows
                problem = None if n else "no rows"
                word = f"rows only: {n}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else word:14} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
