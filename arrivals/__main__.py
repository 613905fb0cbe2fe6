"""``python -m arrivals <command>``: see :mod:`arrivals.plans.run`."""

import sys

from arrivals.plans.run import main

if __name__ == "__main__":
    sys.exit(main())
