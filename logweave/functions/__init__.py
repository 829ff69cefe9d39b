"""Column-expression functions (JVM-side, codegen-friendly, no UDFs)."""
