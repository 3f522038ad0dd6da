"""Operators for preparing training data: quality rules, near-duplicate removal, sharding, language ID, secret scans,
chat formatting, SentencePiece coding, embedding near-duplicates, packing and repeated-passage removal."""
