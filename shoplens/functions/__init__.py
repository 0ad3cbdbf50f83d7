"""Column functions that stay inside whole-stage code generation."""
