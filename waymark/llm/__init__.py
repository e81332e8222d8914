"""Training-data operators: quality, scoring, scanning, packing, deduplication."""
