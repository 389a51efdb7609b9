"""orderloom: raw e-commerce files and event streams to trusted tables, a star schema and reports.

Every public function takes and returns lazy DataFrames; actions happen only in sinks.
"""

from orderloom.lake import Lake, scratch_root
from orderloom.session import spark_session

__all__ = ["Lake", "scratch_root", "spark_session"]
