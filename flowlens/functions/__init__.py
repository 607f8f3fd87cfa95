"""Column expressions and header rules; everything here stays inside the JVM."""
