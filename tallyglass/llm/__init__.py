"""Operators of a training-data pipeline: filters, duplicate removal, scans, layout, packing.

Nothing outside this subpackage imports it.
"""
