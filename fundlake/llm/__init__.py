"""Training-data operators: deduplication, scans, archives, rules, packing, mixing, scoring."""
