"""Table catalogue, readers and sinks."""
