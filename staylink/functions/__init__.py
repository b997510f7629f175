"""Scalar functions: Column in, Column out, JVM-side (no Python per row)
except for the few kernels in :mod:`staylink.functions.similarity`."""
