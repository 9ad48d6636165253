"""venuelake: batch analytics for venue-discovery data, as lazy PySpark plans."""
