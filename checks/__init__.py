"""Registered queries and the SQL they are compared with."""
