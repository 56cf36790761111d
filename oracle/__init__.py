"""Reference answers as plain SQL over the shared tables, one statement per registered query."""
