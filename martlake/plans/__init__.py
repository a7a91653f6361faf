"""Query plans: driver tables bound to operators, plus their oracle SQL."""
