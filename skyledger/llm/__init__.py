"""Training-data operators: tokenizing, deduplication, search, mixing, labelling and scoring."""
