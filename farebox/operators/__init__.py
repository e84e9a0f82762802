"""Transformations: staging, dimensions, fact, profiling, checks, joins."""
