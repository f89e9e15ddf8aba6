"""Whole plans: the retail warehouse and the queries on the shared test tables."""
