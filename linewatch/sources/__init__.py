"""Topics, lookup files, rider preferences."""
