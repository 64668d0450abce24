"""Training-data operators: scans, decontamination, extraction, de-duplication,
packing, quality rules, token counts and language identification.

Nothing else in the library imports this package.
"""
