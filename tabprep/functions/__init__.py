"""Column-level helpers: missing predicates, column kinds, key hashing and
row expressions.  All return Spark ``Column`` objects (JVM side, codegen)."""
