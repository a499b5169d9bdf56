"""Training-data operators: mixing, dedup, formatting, tokens, sharding, scoring. Nothing else in the library imports this."""
