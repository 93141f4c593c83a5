"""Compositions of operators (batch pipelines) and plan checks."""
