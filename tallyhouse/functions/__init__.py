"""Column expressions; none of them touches a DataFrame."""
