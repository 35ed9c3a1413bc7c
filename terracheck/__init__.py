"""terracheck: data quality and anomaly scoring for geolocated asset tables on Spark.

Every operator takes DataFrames (plus small parameters) and returns a lazy
DataFrame.  Actions happen only where an operator must learn a bounded summary
(row counts, hash-bucket counts, a forest of at most T x (2*psi - 1) nodes).
"""

from terracheck.columns import AssetCols, DEFAULT_COLS

__all__ = ["AssetCols", "DEFAULT_COLS"]
__version__ = "0.1.0"
