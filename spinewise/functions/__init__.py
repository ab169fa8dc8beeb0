"""Column functions: missing-value rules, dates, recodes, column-name selection."""
