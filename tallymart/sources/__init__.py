"""Reading drop folders, listing files, writing partitioned tables."""
