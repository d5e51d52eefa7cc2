"""Training-data operators: quality rules, sharding, de-duplication, packing,
personal data, web archives, near-duplicate joins, token codecs, fingerprints."""
