"""Column -> Column scalar helpers. No I/O, no Python UDFs: everything stays in codegen."""
