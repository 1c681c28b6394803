"""Column expressions: parsing, dates, numbers, masking."""
