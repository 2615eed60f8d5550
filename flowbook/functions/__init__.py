"""Column functions: codes, numbers, dates and calendar arithmetic."""
