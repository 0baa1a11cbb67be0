"""Column-to-Column functions: numbers, text, places and labels. No Python UDFs."""
