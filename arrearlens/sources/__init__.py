"""Raw readers, table schemas and layer storage."""
