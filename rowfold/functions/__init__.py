"""Column expressions: hashing, text and JSON, arithmetic, dates, look-ups, seeded draws."""
