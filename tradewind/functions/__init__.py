"""Column expressions and name helpers. No Python UDF: everything per row stays in the JVM."""
