"""Tessera: a PySpark-native engine for building annotated datasets."""
