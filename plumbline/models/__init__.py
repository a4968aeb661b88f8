"""Training, search and explanation on top of ``pyspark.ml``."""
