"""Sources: archive tables, raw station files, typed CSV files, and the
stand-in views built from the driver's tables."""
