"""Column functions: text in, text out, all evaluated by the JVM."""
