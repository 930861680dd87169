"""Training-data operators: classifiers, deduplication, mixing, packing.

Nothing else in the library imports this subpackage.
"""
