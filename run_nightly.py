"""Entry script of the nightly job, see cardwarden/job.py."""

import sys

from cardwarden.job import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
