"""Operators: pure DataFrame -> DataFrame functions, no I/O inside."""
