"""Training-data operators: dedup, packing, filters, scoring and token output."""
