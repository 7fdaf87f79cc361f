"""End-to-end chains composed of the operators, one lazy plan each."""
