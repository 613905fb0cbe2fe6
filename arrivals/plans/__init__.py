"""Plans: the whole pipeline, the registered checks and their SQL oracles."""
