"""Point-in-time occupancy analytics on Spark.

Every row carries two clocks: when something happened (event time) and when it
became known (availability time).  The operators in this package look features
up by availability time, match labels by event time, and never use a row before
it was known.
"""
