"""Column expressions and argument checks shared by batch and streaming."""
