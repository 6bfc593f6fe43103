"""spark-submit entry point: ``spark-submit --py-files velolake.zip velolake_job.py run --lake ...``."""

import sys

from velolake.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
