"""DataFrame -> DataFrame operators, parameterised by column name."""
