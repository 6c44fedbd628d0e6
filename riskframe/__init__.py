"""riskframe: entity-level feature engineering and risk scoring on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small fit/apply
pair) built from the DataFrame API, Spark SQL and ``pyspark.ml``.
"""

__version__ = "0.1.0"
