"""Column expressions: text cleaning, exact decimals, output form."""
