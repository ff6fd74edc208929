"""Whole runs: which frames are built, materialised and written together."""

from popscan.plans.clustered import Clusters, clustered
from popscan.plans.run import materialise, run_analyses, work_folder

__all__ = ["Clusters", "clustered", "materialise", "run_analyses", "work_folder"]
