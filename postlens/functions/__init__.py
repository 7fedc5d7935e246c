"""Column-level functions: text cleaning, dates, JSON parameters, hashtags."""
