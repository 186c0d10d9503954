"""Column expressions; nothing here touches data."""
