"""Column functions: text, quantities, dictionaries, similarity."""
