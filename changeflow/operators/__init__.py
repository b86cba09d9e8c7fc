"""Operators on change tables: predicates, rules, routing, replay and schema changes."""
