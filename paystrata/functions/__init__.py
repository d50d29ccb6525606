"""Column expressions: no frame is read or written here."""
