"""Column functions: no job is started and no row leaves the JVM here."""
