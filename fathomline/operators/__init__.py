"""Order-aware, cast-aware DataFrame operators."""
