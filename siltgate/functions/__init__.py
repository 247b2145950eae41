"""Column expressions: quality rules, dates and stamps. All of them stay inside generated code."""
