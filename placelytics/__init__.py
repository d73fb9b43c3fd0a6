"""Store-visit analytics as PySpark DataFrame operators.

Operators take and return DataFrames. They hold no paths and no session and start no job;
thresholds, areas, tolerances, model versions and dates are arguments.
"""
