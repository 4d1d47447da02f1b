"""Column functions: Column in, Column out, no jobs run."""
