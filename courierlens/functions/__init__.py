"""Column expressions: rounding laws, tiers, business rules, portable random draws."""
