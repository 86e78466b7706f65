"""Column expressions: time, lots, flights, passengers."""
