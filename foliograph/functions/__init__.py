"""Column functions: text, vocabulary and geometry."""
