"""encore: DataFrame operators for user-item interaction logs and feature tables.

Sub-packages:

* ``sources``    -- correction-log parsing, delimited text, attribute-driven schemas, row counts
* ``functions``  -- column expressions (casts, id clean-up, labels, hash buckets, safe ratios)
* ``operators``  -- joins, activity profiles, statistics, splits, indexing, ranking, evaluation, ML
* ``plans``      -- role mapping of the driver tables and the registered query catalogue
* ``streaming``  -- the cleaning operators applied to a Structured Streaming source
"""

from encore.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
