"""Column expressions and numpy kernels shared by the operators."""
