"""Insurance-claims analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames and returns DataFrames, so jobs are
built with ``df.transform`` and Catalyst sees one plan.
"""
