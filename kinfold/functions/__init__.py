"""Column functions: values, names, text."""
