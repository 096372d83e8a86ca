"""``python tests/check_all.py [sf_dir] [query ...]``: every query against its SQL, with times."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as driver
from compare import connect, differences
from conftest import make_session


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf_dir)
    oracles, failed = driver.oracle_sql(), 0
    for name, run in driver.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problems = differences(df, con, oracles[name]) if name in oracles else [f"rows only: {df.count()}"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
            if len(sys.argv) > 2:
                traceback.print_exc()
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:28}{time.time() - start:7.2f}s  {problems or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
