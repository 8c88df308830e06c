"""Training-data operators: deduplication, tokenisation, search, packing,
language, toxicity and secret detection over large document tables.

Nothing else in the library imports this package; it may import the
library's general helpers.
"""
