"""Column expressions shared by every layer; all of them stay inside Catalyst."""
