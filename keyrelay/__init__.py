"""keyrelay - change-driven table synchronisation on Spark.

Change events (insert / update / delete of a business key) are decoded, the rows of
every table that holds the key are pulled with one set-oriented join per table and
batch, written as date-partitioned JSON lines, and a per-case-type index table is
folded forward. Batch backfills and Structured Streaming share the same functions.
"""

from .config import SyncOptions  # noqa: F401

__version__ = "0.1.0"
