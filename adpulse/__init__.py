"""adpulse: Spark-native advertising-log analytics.

Every job is a function from DataFrames plus explicit parameters to a
DataFrame; nothing is collected to the driver.
"""

__version__ = "0.1.0"
