import sys

from trendlens.cli import main

main(sys.argv[1:])
