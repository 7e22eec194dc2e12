"""Registered queries: healthcare views over the given tables, the operators on top, and oracle SQL."""
