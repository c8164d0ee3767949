"""Message parsing and streaming writes."""
