"""Complete jobs: decide, read, transform, check, write, record."""
