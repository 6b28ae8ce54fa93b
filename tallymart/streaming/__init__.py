"""File-arrival streams: append load and Gold refresh."""
