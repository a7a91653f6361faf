import sys

from martlake.cli import main

sys.exit(main())
