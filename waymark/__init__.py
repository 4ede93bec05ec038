"""See README.md."""
