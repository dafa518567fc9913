"""Pure DataFrame -> DataFrame operators, one module per derived table."""
