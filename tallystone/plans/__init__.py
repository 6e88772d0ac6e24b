"""Whole computations: the layered warehouse, the query catalog, its SQL oracles and the table-writing jobs."""
