"""Column expressions: tolerant casts and KPI formulas."""
