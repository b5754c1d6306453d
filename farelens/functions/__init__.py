"""Column functions: calendar, geometry, colour."""
