"""Command line check: python -m tests.check [folder] [name ...] compares queries with their SQL and prints the time of each."""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as entry
from tests.conftest import build_session
from tests.oracle import compare, connect


def main(args: list[str]) -> int:
    folder = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(entry.queries())
    spark, con = build_session(), connect(folder)
    sqls, runs, bad = entry.oracle_sql(), entry.queries(), 0
    for name in names:
        start = time.time()
        try:
            df = runs[name](spark, folder)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                state = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                state = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            state = "FAILED " + "".join(traceback.format_exception_only(e))[:1500]
        bad += not state.startswith(("ok", "rows only"))
        print(f"{name:28s} {time.time() - start:6.1f}s {state}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
