"""Time the headline queries. Prints one JSON line."""

import json
import os
import time

from blockstrata.plans import QUERIES
from blockstrata.session import local_session

HEADLINES = """
block_state_histogram dimension_stats top_voxel_per_column column_classes find_built_region
surface_columns edge_preserving_smooth nearest_valid liquid_quads exposed_faces enclosed_filter
cell_buckets connected_components component_composition extract_instances terrain_height
segment_buildings segment_trees greedy_quads heightfield_mesh export_tiles spawn_search
colour_legend landmark_blobs frame_time_windows solve_gain parent_chain
""".split()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8, app="bench")
    QUERIES["label_histogram"](spark, sf_dir).collect()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
