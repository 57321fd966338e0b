"""Registered queries over the test tables, each with its check in SQL where SQL can say it."""
