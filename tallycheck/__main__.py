import sys

from tallycheck.cli import main

sys.exit(main())
