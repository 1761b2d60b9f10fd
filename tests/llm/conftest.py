"""One BLAS thread per process: the matrices are small, and tasks run side by side."""

import os

os.environ.setdefault("OMP_NUM_THREADS", "1")
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
