"""Record-level data preparation on Spark DataFrames.

Operators are plain ``DataFrame -> DataFrame`` functions driven by
configuration, so the same code serves any table; the hospital admission
tables in :mod:`wardflow.reference` are one configuration.
"""
