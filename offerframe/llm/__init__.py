"""Training-data operators (quality, toxicity, archives, dedup, packing, mixing,
chat formatting, license scans).  Nothing outside this subpackage imports it."""
