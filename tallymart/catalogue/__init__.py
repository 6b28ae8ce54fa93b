"""Registered queries, the inputs they derive from the test tables, and their SQL twins."""
