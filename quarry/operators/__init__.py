"""DataFrame -> DataFrame operators, one module per job family."""
