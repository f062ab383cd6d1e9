"""skyledger — Spark DataFrame operators for cloud billing, access and traffic data.

Every operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver except small, size-checked policy tables.
"""

__version__ = "0.1.0"
