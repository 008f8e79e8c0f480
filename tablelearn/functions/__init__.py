"""Column-level expressions (JVM-side, codegen-friendly) used by operators."""
