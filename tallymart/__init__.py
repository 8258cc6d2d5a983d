"""tallymart: published count files -> validated star schema, on Spark DataFrames.

Sub-packages
------------
functions   Column -> Column helpers (row sums, ratios, text, calendar) and column-name helpers
sources     CSV / ZIP / Parquet scans, header checks, sinks
operators   DataFrame -> DataFrame operators (filter, join, aggregate, reshape, profile, quality)
plans       the three end-to-end jobs built from the above
"""

__version__ = "0.1.0"
