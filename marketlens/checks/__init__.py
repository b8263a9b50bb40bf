"""marketlens.checks."""
