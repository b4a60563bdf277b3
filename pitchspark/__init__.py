"""pitchspark: Spark-native match, roster and results analytics.

Every public operator is a function ``DataFrame -> DataFrame`` that only
declares a logical plan; Catalyst and AQE choose the physical strategy.
"""

__version__ = "0.1.0"
