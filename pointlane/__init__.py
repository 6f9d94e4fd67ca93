"""A Spark engine for sequences of 3-D sensor frames: crop, cluster, track, fuse, evaluate, report."""
