"""voxelframe: region time-series analytics expressed as Spark DataFrame jobs.

Sub-packages:
  sources    - readers and writers (work-lists, per-scan tables, voxel/atlas
               tables, the keyed latest-version table, archive listings, sinks)
  functions  - column-level helpers (path parsing, protected division,
               JSON cells, region names)
  operators  - relational and modelling operators (ordinals, rolling windows,
               as-of join, region means, metrics, Gram/linear fits, trees,
               feed-forward nets, formula search, pandas-UDF surface)
  plans      - composed jobs and the registered query catalogue
  streaming  - incremental extraction over a growing directory of voxel files
"""

from voxelframe.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
