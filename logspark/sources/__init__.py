"""Sources of log objects, records and index tables."""
