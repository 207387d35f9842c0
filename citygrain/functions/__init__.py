"""Column expressions: tiles, coordinate systems, geometry on coordinate arrays, text."""
