"""quern: analytics operators written as Spark DataFrame transformations.

Every operator takes DataFrames and returns DataFrames. Scalars that an operator
needs on the driver (split boundaries, bin edges) are bounded by a parameter and
never grow with the data.
"""

__version__ = "0.1.0"
