"""Stream landing."""
