"""Silver, quality and Gold operators: pure DataFrame -> DataFrame transforms."""
