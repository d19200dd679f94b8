"""Column builders. Everything here is a native expression: no Python runs on the executors."""
