"""Check of every operator on the given tables: data mapping, queries and oracle SQL."""
