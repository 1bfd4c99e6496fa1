"""lodestar: reusable Spark analytics jobs.

Every public function takes Spark DataFrames (plus plain parameters) and
returns a DataFrame, a fitted Spark ML model, or a small tidy DataFrame.
No function creates a session, collects a large result, or runs a Python
UDF on the row path; heavy work stays inside Catalyst / Tungsten.
"""

__version__ = "0.1.0"
