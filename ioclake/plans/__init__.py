"""Bindings of the driver tables to the operators, and the query catalog."""
