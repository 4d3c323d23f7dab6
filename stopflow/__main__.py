import sys

from stopflow.cli import main

sys.exit(main())
