"""Column expressions: arithmetic guards, labels, dates, ratio and valuation formulas."""
