"""Compositions of operators that are driven by a specification."""
