"""marketlens.operators."""
