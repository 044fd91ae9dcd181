"""stintlake: race-season star-schema analytics on Spark DataFrames.

Every public operation takes DataFrames (plus column names and parameters)
and returns a DataFrame; Catalyst plans the work, nothing is executed on the
driver beyond tiny parameter tables.
"""

__version__ = "0.1.0"

# Fixed value of the source data model: finishing order given to a
# non-classified result (retirement, disqualification, ...).
DNF_POSITION_ORDER = 999
