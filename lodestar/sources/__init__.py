"""Sources (S1-S8), derived views of the driver tables, and sinks (K1-K5)."""
