"""tallycast: count forecasting over many event series, built on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or a one-row gate
DataFrame) that runs on Spark SQL, window functions and Spark ML.
"""

__version__ = "0.1.0"
