"""Column helpers. None of them touches a DataFrame."""
