"""Column expressions: missing values, longitudes, days, text. No Python UDF."""
