"""Per-source contracts and the daily load that follows them."""
