"""Structured Streaming forms of the batch operators.

The batch transformations are reused unchanged on ``readStream`` input; every
query writes through a checkpointed sink below the shared checkpoint folder,
so a restarted or re-planned query resumes where it stopped.
"""
