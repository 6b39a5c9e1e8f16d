"""Lodestone: a PySpark-native evidence and text-mining engine."""
