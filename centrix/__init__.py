"""centrix: centroid clustering (Lloyd k-means) as Spark DataFrame jobs.

Points live in a DataFrame ``(point_id BIGINT, coord ARRAY<BIGINT|DOUBLE>)``;
centroids are the only thing that moves through the driver (k x d numbers per
iteration).  See README.md for the operator map.
"""

from centrix.session import checkpoint_dir, get_spark, scratch_path

__all__ = ["get_spark", "checkpoint_dir", "scratch_path",
           "fit", "kmeanspp", "assign", "expand", "nmi", "load_points", "load_dataset"]


def __getattr__(name):
    # lazy re-exports, so importing the package does not import every module
    if name == "fit":
        from centrix.plans.lloyd import fit
        return fit
    if name == "kmeanspp":
        from centrix.operators.seed import kmeanspp
        return kmeanspp
    if name == "assign":
        from centrix.operators.assign import assign
        return assign
    if name == "expand":
        from centrix.operators.expand import expand
        return expand
    if name == "nmi":
        from centrix.operators.metrics import nmi
        return nmi
    if name == "load_points":
        from centrix.sources.text import load_points
        return load_points
    if name == "load_dataset":
        from centrix.sources.dataset import load_dataset
        return load_dataset
    raise AttributeError(name)
