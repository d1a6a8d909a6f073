"""Driver tables, the adapters that derive readings and alerts from them, archive tables."""
