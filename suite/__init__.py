"""Registered queries, their bronze inputs and the SQL they are checked against."""
