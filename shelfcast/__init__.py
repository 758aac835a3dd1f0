"""shelfcast — retail demand analytics on Spark.

Wide daily sales -> partitioned item x store x day fact -> checks -> analysis
queries -> curated rollups -> backtested 28-day forecasts -> scorecards, all as
DataFrame / SQL / window / pyspark.ml plans.
"""

__version__ = "0.1.0"
