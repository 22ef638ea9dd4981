"""``spark-submit job.py ...``: one batch, see ``rejoinder/__main__.py``."""

import sys

from rejoinder.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
