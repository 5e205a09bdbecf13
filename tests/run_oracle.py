"""Run every registered query against its DuckDB oracle.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_util import compare, duck  # noqa: E402

from quire.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in sqls:
            n = q(spark, sf_dir).count()
            print(json.dumps({"name": name, "rows_only": n, "sec": round(time.time() - t0, 1)}))
            continue
        try:
            r = compare(spark, con, name, q, sqls[name], sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "error": f"{type(e).__name__}: {e}"[:2000]}
        r["sec"] = round(time.time() - t0, 1)
        if not r.get("hash_match"):
            bad += 1
        print(json.dumps(r, default=str), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
