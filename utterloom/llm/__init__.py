"""Training-data operators: packing, deduplication, scans, filters, decontamination, extraction.

Nothing outside this subpackage imports it.
"""
