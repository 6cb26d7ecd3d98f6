"""Driver-table fixtures and file formats."""
