"""Registered queries: each operator applied to the given tables, plus its SQL twin."""
