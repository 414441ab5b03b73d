"""Training-data operators: scans, filters, joins, mixing, tokenising.

Nothing outside this subpackage imports it.
"""
