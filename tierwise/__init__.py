"""tierwise: a Spark-native mortgage-portfolio risk engine.

Everything is a DataFrame -> DataFrame function built from Spark SQL
built-ins; actions happen only in sinks (``operators.lake``,
``streaming``) and in the few places that must materialize a bounded,
small result (documented where they occur).
"""

__all__ = ["session", "schemas", "policies"]
