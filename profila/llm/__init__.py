"""Training-data operators: toxicity, license scans, mixing, line and substring
dedup, sharding, vector search, decontamination, sanitisation, SimHash groups."""
