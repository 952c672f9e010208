"""Column builders: no actions, no Python UDFs."""
