"""meterwatch: finding irregular consumption in metered series, as Spark jobs.

Every operator takes and returns DataFrames; id, period, value and group
columns are parameters.
"""
