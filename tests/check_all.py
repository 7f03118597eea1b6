"""Run every registered query at one scale next to its SQL.  Usage: check_all.py SF_DIR [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import difference, duck, duck_table, spark_table  # noqa: E402
from tradelake.session import local_session  # noqa: E402


def main(sf_dir, *names):
    spark = local_session(8)
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            got = spark_table(queries[name](spark, sf_dir))
            took = time.time() - started
            if name in oracles:
                problem = difference(got, duck_table(con, oracles[name]))
                state = "ok" if problem is None else "BAD " + problem
            else:
                state = "no sql"
        except Exception as exc:
            took, got = time.time() - started, ([], [])
            state = f"FAIL {type(exc).__name__}: {str(exc)[:1500]}"
        bad += state.startswith(("BAD", "FAIL"))
        print(f"{name:32s} rows={len(got[1]):6d} {took:6.2f}s {state}", flush=True)
    print(f"{bad} problems; no query: {sorted(set(oracles) - set(queries))}")


if __name__ == "__main__":
    main(*sys.argv[1:])
