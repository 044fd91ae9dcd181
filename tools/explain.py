"""Print the formatted physical plan of a registered query.

    python tools/explain.py NAME [sf_dir]

Useful checks: ``PushedFilters`` / ``ReadSchema`` at the scans, broadcast
versus sort-merge joins, partial + final aggregates, ``WindowGroupLimit``
for per-team top-k, and no ``ArrowEvalPython`` outside the models that need
a distribution function.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    from stintlake.plans import catalog
    from stintlake.session import get_spark

    spark = get_spark()
    catalog.run(spark, name, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
