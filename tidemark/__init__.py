"""Point-in-time reference data on Spark: scans, diffs, intervals, matching, publication."""
