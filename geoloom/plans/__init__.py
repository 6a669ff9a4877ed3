"""End-to-end plans and the driver query catalogue."""
