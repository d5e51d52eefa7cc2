"""Record each registered query's Spark output schema (run at sf0.001).

The SQL oracles are wrapped with this schema so both sides round doubles to
eight significant digits and widen integers to BIGINT identically.
usage: python tools/gen_schemas.py [name-substring ...]
"""
from __future__ import annotations

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tabloom.session import get_session  # noqa: E402
from tabloom.plans import load_all  # noqa: E402

PATH = os.path.join(ROOT, "tabloom", "plans", "schemas.json")


def main():
    pats = sys.argv[1:]
    spark = get_session()
    cur = json.load(open(PATH)) if os.path.exists(PATH) else {}
    for name, (fn, _sql) in load_all().items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            df = fn(spark, "/root/testdata/sf0.001")
            cur[name] = [[f.name, f.dataType.simpleString()] for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            print("schema failed", name, str(e)[:300])
    json.dump(dict(sorted(cur.items())), open(PATH, "w"), indent=0)
    print("schemas:", len(cur))


if __name__ == "__main__":
    main()
