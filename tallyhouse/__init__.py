"""Card-transaction analytics and everyday table work, written for Spark.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns, so the optimizer sees whole plans and batch and streaming jobs share
one set of definitions.
"""
