"""Column expressions; no Python runs on executors for any of them."""
