"""Column builders: no DataFrame, no session, usable in any select or filter."""
