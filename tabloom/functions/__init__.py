"""Column-expression helpers: everything here returns a ``Column``."""
