"""The small tables the tests read, and the time their literal rows start at."""

from datetime import datetime

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)
