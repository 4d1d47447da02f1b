"""Pipelines: compositions of operators that answer one question end to end."""
