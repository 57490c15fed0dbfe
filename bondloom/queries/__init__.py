"""Registered queries. Each module has QUERIES (name -> plan) and SQL (name -> check)."""
