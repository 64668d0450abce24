"""tripwright: a Spark-native trip warehouse.

Loads vehicle-trip files into a typed staging layer, maintains region,
datasource and event-time dimensions with stable surrogate keys, keeps a
month-partitioned trip fact that can be reloaded without duplicates, derives
a daily per-region aggregate (bounding box + trip count) and answers the
spatial / temporal questions asked of those tables.  Everything is DataFrame
or Spark SQL code built from ``pyspark.sql.functions``.
"""

__version__ = "0.1.0"
