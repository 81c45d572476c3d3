"""Column expressions: text features, roles, outcomes, timestamps, labels."""
