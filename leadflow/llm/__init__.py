"""Training-data operators (quality, near-dedup, token output, packing, ...). Nothing outside imports this package."""
