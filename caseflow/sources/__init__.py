"""Landing zone and run log."""
