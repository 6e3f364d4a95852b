"""``python -m hourlake ...``: the ingest command line."""

import sys

from hourlake.plans.cli import main

sys.exit(main())
