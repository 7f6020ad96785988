"""Operators: DataFrame -> DataFrame steps (extract, clean, sessions, features, labels, ML, metrics)."""
