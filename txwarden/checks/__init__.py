"""Registered queries and the SQL that states their expected results."""
