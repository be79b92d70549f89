"""Execution patterns shared by the operators: shared storage, skew, ranks."""
