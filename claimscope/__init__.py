"""claimscope: provider-level claims risk analytics on Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function; nothing is
collected to the driver inside an operator.
"""

__version__ = "0.1.0"
