"""Where log rows come from and where results go."""
