"""Registered queries: each has a DataFrame form and, where possible, SQL."""
