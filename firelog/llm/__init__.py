"""Training-data operators: language, toxicity, PII, mixing, extraction, search, fingerprints, joins, tokens."""
