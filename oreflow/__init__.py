"""Layered (bronze, silver, gold) analytics on Spark DataFrames.

Every transform is ``f(df, ...) -> DataFrame`` and stays lazy. Only sinks,
stream runners and the publish gate start jobs.
"""

__version__ = "0.1.0"
