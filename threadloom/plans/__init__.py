"""Bindings of the operators to stored tables, and the registered queries."""
