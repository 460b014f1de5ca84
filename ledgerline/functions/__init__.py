"""Column expressions (JVM-side, codegen-friendly): cleaning rules and the
credit-score rule tables."""
