"""Jobs that read and write tables."""
