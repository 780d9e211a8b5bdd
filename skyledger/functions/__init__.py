"""Column expressions: text helpers and the named field transforms."""
