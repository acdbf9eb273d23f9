"""Run every registered query at a scale: ``python tests/check_all.py DIR [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from marquee.session import local_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            if name in oracles:
                problem, _ = compare(spark, con, sf_dir, queries[name], oracles[name])
            else:
                problem = "" if queries[name](spark, sf_dir).collect() else "no rows"
        except Exception:
            problem = "\n".join(traceback.format_exc().splitlines()[-6:])[:1500]
        failed += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem[:900]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
