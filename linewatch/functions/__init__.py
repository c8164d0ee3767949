"""Column expressions: casts, keys, calendar, flags, weather wording, texts."""
