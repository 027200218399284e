import sys

from parchment.cli import main

sys.exit(main())
