"""Training-data operators: fingerprints, tokens, classifiers, dedup, rules and mixing."""
