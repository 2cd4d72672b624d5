"""Where target tables are read from and snapshots are written to."""
