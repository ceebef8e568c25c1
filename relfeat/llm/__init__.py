"""Training-data operators: dedup, filters, tokenization, sharding, archives, extraction. Nothing outside imports this."""
