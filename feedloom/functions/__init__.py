"""Column functions: text, identifiers, URLs, dates and lists, all JVM-side; ``udfs`` holds the few that need Python."""
