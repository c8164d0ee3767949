"""Table writes: create, append, replace, merge."""
