"""Plans that bind the operators to tables."""
