"""Training-data operators: deduplication, packing, joins on word shingles,
language-model scores, decontamination, sharding, token files, secret,
quality and licence scans. Nothing outside this package imports it."""
