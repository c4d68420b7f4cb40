"""Text snapshots in, layer tables and reports out."""
