"""Column expressions: titles, identities, dates, extents, ranges, sort keys. All of them stay inside the JVM."""
