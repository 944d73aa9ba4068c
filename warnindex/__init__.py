"""Warning intensity analytics on Spark.

Message histories -> clean schema -> region/class join -> per-message
durations (lead gap per area) -> severity-weighted annual scores -> indices
against a baseline year -> composite and trend; plus data-quality reports.
Everything is DataFrame / Spark SQL work over all areas and years at once.
"""

__version__ = "0.1.0"
