"""rawline: batch pipeline operators on Spark DataFrames.

Every operator is a function from DataFrame(s) to DataFrame. Run times are
always arguments (never ``now()`` inside an operator) so a rerun of a job
computes the same rows.
"""

__version__ = "0.1.0"
