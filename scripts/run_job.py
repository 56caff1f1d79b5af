"""Launcher for spark-submit: ``spark-submit --py-files hitroll.zip scripts/run_job.py ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitroll.plans.job import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
