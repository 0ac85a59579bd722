"""Column expressions: cleaning, text rules, categories, geometry, months and bins."""
