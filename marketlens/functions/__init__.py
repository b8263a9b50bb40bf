"""marketlens.functions."""
