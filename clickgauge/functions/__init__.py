"""Column expressions: pure ``Column -> Column`` builders with no session or I/O."""
