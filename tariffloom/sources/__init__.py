"""Where contract tables come from and where results go."""
