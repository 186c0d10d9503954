"""Reading and writing: landed files, month partitions, tables."""
