"""Column builders, and the helpers that keep hot keys and global orders off a single task."""
