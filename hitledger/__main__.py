import sys

from hitledger.cli import main

sys.exit(main())
