"""Column functions: text cleaning, typed parsing, exact rounding."""
