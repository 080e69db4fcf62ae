"""Model fits, exact metrics, tuning and recommendation."""
