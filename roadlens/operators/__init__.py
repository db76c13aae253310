"""DataFrame -> DataFrame building blocks: dedup, cleaning, keys, star, checks, profiles."""
