"""Column -> Column helpers: text, tolerant typing, surrogate keys."""
