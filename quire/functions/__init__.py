"""Column expressions. Everything here is a built-in Spark expression
(codegen-friendly) but ``markdown``, which reads one page at a time in Python."""
