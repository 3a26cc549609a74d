"""Scalar column functions: strings, dates, geometry, arrays, JSON and hashes."""
