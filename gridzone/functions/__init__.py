"""Column-expression functions (projections, z-order keys, text labels, band maths)."""
