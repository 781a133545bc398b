"""Part of cytoplan: see the package docstring."""
