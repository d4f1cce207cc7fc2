"""Column expressions: cleaning, time slices, hashes, maps, agents."""
