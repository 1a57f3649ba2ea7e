"""Column helpers and the distributed ordering primitives."""
