"""Registered queries, one module per inventory section."""
