"""Training-data operators: WARC, licences, quality, extraction, dedup, packing, sharding, LM scores, decontamination."""
