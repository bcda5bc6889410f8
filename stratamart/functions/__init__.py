"""Column functions: text cleaning, guarded conversion, date arithmetic."""
