"""strandline: change-data history, compliance marts and retrieval on PySpark.

Everything is a plain ``DataFrame -> DataFrame`` function; see the README for
the map from operator to module.
"""
