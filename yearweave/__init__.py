"""yearweave: harmonize yearly record files into one typed multi-year table on Spark.

Every operator is a DataFrame transformation or a Column expression built from
``pyspark.sql.functions``; nothing runs row by row in Python.
"""

__version__ = "0.1.0"
