"""Training-data operators: quality, deduplication, safety, formatting, packing.

Ten operators, each in its own module with a general DataFrame interface;
``queries`` registers one query for each.  Nothing outside this package
imports it.
"""
