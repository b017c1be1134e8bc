"""Column-expression builders; every function returns a ``Column``."""
