from trilayer.sources.delimited import read_delimited, read_sources
from trilayer.sources.tables import read_partitioned, read_side

__all__ = ["read_delimited", "read_partitioned", "read_side", "read_sources"]
