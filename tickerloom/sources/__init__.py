"""Reading landed payloads, mapping them to typed rows, and writing tables."""
