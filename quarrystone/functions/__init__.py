"""Column helpers. Every helper returns a built-in Spark expression, so it stays in whole-stage codegen."""
