import sys

from linkloom.cli import main

sys.exit(main())
