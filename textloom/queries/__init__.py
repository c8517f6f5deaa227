"""Registered queries and the SQL that judges them."""
