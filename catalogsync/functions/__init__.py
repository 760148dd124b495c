"""Column expressions. All built-in functions, so all of it stays in code generation."""
