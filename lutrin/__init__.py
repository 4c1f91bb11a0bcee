"""lutrin: a usage warehouse for library networks, written as Spark DataFrame jobs."""

from lutrin.schemas import TABLES, empty_table, table
from lutrin.session import build_session

__all__ = ["TABLES", "build_session", "empty_table", "table"]
