"""Scalar column expressions; all stay inside the JVM."""
