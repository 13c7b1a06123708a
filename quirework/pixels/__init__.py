"""Vectorised NumPy kernels on images."""
