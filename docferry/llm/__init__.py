"""Training-data operators: language-model scoring, archives, fingerprints,
token files, similarity joins, packing, mixing, toxicity, licences and nearest
neighbours. Each module holds one operator; ``queries`` registers them."""
