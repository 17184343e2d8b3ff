"""``python -m lattica``."""

import sys

from lattica.plans.cli import main

sys.exit(main())
