"""Training-data operators: quality, personal data, chat repair, mixing, secrets, toxicity, search, packing, near copies."""
