"""Pure DataFrame functions: rows in, rows out, nothing collected."""
