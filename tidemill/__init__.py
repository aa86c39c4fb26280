"""tidemill — real-time retail analytics as Spark DataFrame transformations.

Every operator is a pure ``DataFrame -> DataFrame`` function (batch form, checked
against a SQL oracle); operators that keep per-key state also have a Structured
Streaming form in :mod:`tidemill.streaming` with the same semantics.
"""

__version__ = "0.1.0"
