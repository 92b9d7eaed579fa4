"""ledgerloom: feature engineering on transaction tables, written for Spark.

Every operator is a function from DataFrames to DataFrames.  Anything that has to be learned
from the data first (a count table, per-key statistics, label codes) is *fitted* into a small
keyed table that lives in the cluster's shared folder, and then *applied* with a join whose
strategy follows from the measured size of that table.
"""
