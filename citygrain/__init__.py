"""Urban risk analytics as Spark DataFrame operators, for many cities at once."""
