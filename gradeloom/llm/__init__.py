"""Operators for preparing training text, vectors and benchmarks. Nothing outside this folder imports it."""
