"""Registered queries: wiring of tables to operators, with the equivalent SQL."""
