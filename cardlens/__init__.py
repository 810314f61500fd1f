"""Card-transaction fraud analytics as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller acts on the result.  Sub-packages: ``sources``, ``functions``,
``operators``, ``sinks``, ``streaming`` and ``plans`` (whole jobs).
"""

__version__ = "0.1.0"
