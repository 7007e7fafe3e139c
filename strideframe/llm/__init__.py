"""Training-data operators: filtering, deduplication, scoring and tokenisation of text corpora."""
