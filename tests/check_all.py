"""Run every query against its SQL: ``python tests/check_all.py [sf_dir] [key …]``."""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle import connect, differences  # noqa: E402

from rivulet.plans.registry import ORACLES, QUERIES  # noqa: E402
from rivulet.runtime import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(sf_dir)
    bad = []
    for key in keys:
        begun = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in ORACLES:
                problem = differences(df, con, ORACLES[key])
                note = "same" if problem is None else problem
            else:
                problem, note = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - a report over all keys
            problem = note = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem:
            bad.append(key)
        print(f"{key:28s} {time.time() - begun:6.1f}s  {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
