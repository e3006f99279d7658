"""Reading and writing tables, snapshots and increments."""
