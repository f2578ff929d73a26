"""Column-level functions: Column -> Column, JVM-side except NFKC/NFKD."""
