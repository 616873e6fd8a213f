"""Operators for training data: exact and near deduplication, classifiers, mixing, packing, archives, chats."""

import os

# The models that are fitted on the driver have small matrices, which more threads only make slower. It takes effect
# where numpy is not loaded yet.
os.environ.setdefault("OMP_NUM_THREADS", "1")
