"""Question-and-answer forum analytics as plain PySpark transformations.

Every analysis is a function from DataFrames to a lazy DataFrame; Catalyst and
AQE choose the physical plan.  ``sources`` and ``sinks`` read and write files,
``functions`` holds column expressions, ``operators`` holds the reusable
relational building blocks and ``plans`` the analyses themselves.
"""
