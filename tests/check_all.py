"""Command line: compare every query with its SQL check. `check_all.py [folder] [name part]`"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import differences, duck, session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    spark, con = session(), duck(folder)
    spark.sparkContext.setLogLevel("ERROR")
    checks, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if part not in name:
            continue
        start = time.perf_counter()
        try:
            if name in checks:
                found = differences(run(spark, folder), con, checks[name])
            else:
                found = [] if run(spark, folder).collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        took = time.perf_counter() - start
        print(f"{'ok ' if not found else 'BAD'} {name} {took:.2f}s{'' if name in checks else ' (rows only)'}", flush=True)
        for line in found:
            print("    " + line, flush=True)
        bad += bool(found)
    extra = checks.keys() - entry.queries().keys()
    print(f"{bad} bad, {len(entry.queries())} queries, {len(checks)} checks, extra {sorted(extra)}")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
