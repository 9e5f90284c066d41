"""Print ``explain("formatted")`` of the headline queries (or the ones named).

Usage: python tools/explain_plans.py [sf_dir] [query ...]

Queries over the two-run scenario checkpoint their upstream steps while they are built,
so their printed plan starts from the staged tables.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from filegate.plans import catalog  # noqa: E402
from filegate.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = local_session()
    registry = catalog.registry()
    for name in names:
        print(f"===== {name} =====")
        registry[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
