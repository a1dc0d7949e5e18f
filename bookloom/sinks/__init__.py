"""Writing what is published."""
