"""Training-data operators: decontamination, near-duplicates, quality rules,
secret scans, packing, WARC archives, language-model scores, token-id files,
sharding and token counts.  Nothing outside this subpackage imports it."""
