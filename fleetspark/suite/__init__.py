"""Registered queries on the driver tables, each with an SQL statement of the same result."""
