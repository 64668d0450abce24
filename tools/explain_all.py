"""Write the formatted physical plan of every registered query to a file and
flag plan shapes that need a look at scale.

Usage: python tools/explain_all.py [sf_dir] [out_file]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Plan fragments that deserve a second look at 100 TB.
FLAGS = {
    "BroadcastNestedLoopJoin": "nested-loop join (every row against every row)",
    "CartesianProduct": "cartesian product",
    "SortAggregate": "sort-based aggregate (non-fixed-width buffer): check its input size",
    "SinglePartition": "single-partition exchange: check it follows a partial aggregate "
                       "or a size-bounded input",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "/tmp/tripwright_plans.txt"
    from tripwright.plans.registry import QUERIES
    from tripwright.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    summary = []
    with open(out, "w") as f:
        for name, fn in QUERIES.items():
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                fn(spark, sf).explain(mode="formatted")
            plan = buf.getvalue()
            hits = [why for frag, why in FLAGS.items() if frag in plan]
            summary.append((name, hits))
            f.write(f"===== {name}\n{plan}\n")
    for name, hits in summary:
        print(f"{name:28s} {'; '.join(hits) if hits else 'ok'}")
    print("plans written to", out)


if __name__ == "__main__":
    main()
