"""Column functions (text, numbers, code-switching) and their fixed lexicons."""
