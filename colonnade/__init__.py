"""PySpark-native analytics engine: typed sessions, dialect, operators, streaming."""
