"""destrank: Spark-native destination ranking.

Every public function takes and returns DataFrames (or Columns) built
from built-in Spark expressions, so Catalyst plans the whole pipeline:
pruning and filters reach the scans, aggregations combine map-side, and
joins are chosen from measured sizes by adaptive execution.
"""

from destrank.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
