"""Script for ``spark-submit``; see ``python -m tallyhouse --help``."""

import sys

from tallyhouse.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
