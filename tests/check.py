"""Compare queries with their SQL: ``python -m tests.check [sf] [key ...]``."""

from __future__ import annotations

import sys
import time
import traceback

from meterwatch.plans.catalog import ORACLES, QUERIES
from meterwatch.session import build_session
from tests.compare import connect, differences


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0][0].isdigit() else "0.01"
    keys = args or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for key in keys:
        start = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in ORACLES:
                problems = differences(con, df, ORACLES[key])
                note = f"{con.sql(f'select count(*) from ({ORACLES[key]})').fetchall()[0][0]} rows"
            else:
                problems, note = [], f"{df.count()} rows, no SQL"
        except Exception as error:
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
            if "-v" in keys:
                traceback.print_exc()
        took = time.time() - start
        print(f"{'ok  ' if not problems else 'FAIL'} {key} {took:.2f}s {note} {'; '.join(problems)}", flush=True)
        if problems:
            failed.append(key)
    print(f"{len(keys) - len(failed)} ok, {len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
