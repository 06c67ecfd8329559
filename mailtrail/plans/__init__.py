"""End-to-end jobs that read, validate, write and publish."""
