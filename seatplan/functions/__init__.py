"""Column helpers shared by the operators. Everything here is a built-in expression."""
