"""Registered queries over the fixture tables, each with the SQL that gives the same rows."""
