"""Run every registered query against its oracle and print one line per query.

Usage: python tests/run_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from compare import diff, digest, duck, duck_rows, spark_rows  # noqa: E402
from spendlens.session import local_session, shared_folder  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    shared_folder(spark)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and not any(w in name for w in wanted):
            continue
        t0 = time.time()
        sc, sr = spark_rows(fn(spark, sf_dir))
        t1 = time.time()
        if name not in oracle:
            print(f"{name}: rows={len(sr)} (no oracle) spark={t1 - t0:.1f}s")
            continue
        dc, dr = duck_rows(con, oracle[name])
        a, b = digest(sc, sr), digest(dc, dr)
        ok = a == b
        bad += not ok
        print(
            f"{name}: {'OK ' if ok else 'BAD'} rows={a[0]}/{b[0]} cols={'ok' if a[1] == b[1] else (a[1], b[1])}"
            f" spark={t1 - t0:.1f}s"
        )
        if not ok and a[1] == b[1]:
            only_s, only_d = diff(sc, sr, dc, dr, 3)
            for x in only_s:
                print("   spark:", x[:400])
            for x in only_d:
                print("   duck: ", x[:400])
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
