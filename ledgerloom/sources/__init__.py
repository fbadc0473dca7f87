"""Reading and writing snapshots, seeds and layered tables."""
