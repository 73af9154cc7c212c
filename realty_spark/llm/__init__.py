"""Training-data operators: near-dedup, token files, top-k search, language, licences, quality, packing, mixing, substring dedup, nearest neighbours."""
