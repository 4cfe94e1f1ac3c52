"""Training-data operators: formatting, near-dedup, packing, filters, search, classifiers, extraction, mixing."""
