"""Column expressions: everything here is a built-in expression, so it stays in codegen."""
