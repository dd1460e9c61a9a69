"""synthtext: a PySpark-native engine for producing and curating synthetic text.

Sub-packages: ``sources`` (prompt readers), ``functions`` (Column operators),
``operators`` (DataFrame operators), ``sinks`` (record writers),
``streaming`` (Structured Streaming forms) and ``plans`` (batch job and the
query registry).
"""

__version__ = "0.1.0"
