"""Column functions: text, link, date and rule expressions that stay inside the JVM."""
