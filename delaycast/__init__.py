"""delaycast: Spark-native vehicle-delay and weather analytics.

Every operator is a plain function over DataFrames / Columns that takes
column names as parameters, so it runs on the vehicle/weather feeds and on
any other table alike.
"""

__version__ = "0.1.0"
