"""Topics, fact routing and raw log landing."""
