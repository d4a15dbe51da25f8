"""Raw readers, layer tables and writers."""
