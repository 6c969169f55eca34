"""Column functions: text cleaning, lenient parsing, classes, seeded draws."""
