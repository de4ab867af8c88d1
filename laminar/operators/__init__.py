"""Warehouse operators: pure DataFrame -> DataFrame transforms, lazily planned."""
