"""Column expressions: URL rules, text rules, times and identities."""
