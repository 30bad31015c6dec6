"""Queries bound to the given test tables, each with equivalent SQL where SQL can say it."""
