"""crossfade: item recommendations on Spark DataFrames.

Sub-packages: ``sources`` (tables in and out), ``functions`` (column expressions), ``operators``
(DataFrame -> DataFrame steps), ``plans`` (whole batch runs) and ``streaming``.
"""

__version__ = "0.1.0"
