"""Training-data operators: deduplication, filtering, detection, formatting,
tokenising, search and packing. Nothing else in the library imports this package."""
