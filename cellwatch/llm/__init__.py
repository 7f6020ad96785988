"""Training-data operators: mixing, decontamination, extraction, scoring and de-duplication.

Nothing else in the library imports this subpackage.
"""
