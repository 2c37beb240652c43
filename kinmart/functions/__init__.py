"""Column functions: casts that never raise, feature makers, bit arithmetic."""
