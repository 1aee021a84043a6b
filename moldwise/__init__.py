"""moldwise: Spark-native scrap analytics for shop-floor sensor and production data.

Everything is expressed with the DataFrame API so Catalyst can push filters and
projections into the scans, plan partial aggregation, and pick join strategies.
"""

from moldwise.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
