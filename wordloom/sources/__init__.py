"""Where corpora come from and results go."""
