"""DataFrame-to-DataFrame operators. Nothing here collects rows or runs Python per row."""
