"""Column functions: tolerant parsing, row hashes, calendar attributes."""
