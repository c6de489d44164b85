"""lodestrata: a PySpark-native engine for discussion archives and text corpora."""
