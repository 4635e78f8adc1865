"""Operators for preparing training corpora: cleaning, deduplication, mixing,
sharding, packing, scoring and search over documents and embeddings."""
