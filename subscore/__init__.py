"""Subscriber credit scoring on Spark: monthly datamart, labels, features,
boosted-tree scores, exact ranks, lift and profit tables.

Every step is a function from DataFrame to DataFrame. Months are never taken
from the clock: callers pass ``as_of`` and a lag, or a month end.
"""
