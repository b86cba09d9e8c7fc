import sys

from changeflow.cli import main

sys.exit(main())
