"""marketlens.sources."""
