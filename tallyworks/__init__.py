"""Batch analytics on Spark: a records warehouse with its reports, and text-corpus statistics.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or
Column) without running an action; only the sinks write.
"""
