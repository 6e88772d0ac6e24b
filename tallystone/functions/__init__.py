"""Column expressions: one scalar rule each, built-in functions only, no session settings."""
