"""End-to-end jobs over the wide user table."""
