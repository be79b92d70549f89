"""Registered queries: every operator on tables derived from the given ones,
with the equivalent SQL where there is one."""
