"""Memory of the Python workers that read texts."""

import pyarrow as pa

from emberline.llm.texts import reach_package


def kept(batches):
    """MB that the worker keeps of 100 arrays of 2 MB and of as much Arrow memory, all freed but the last."""
    import gc

    import numpy as np

    def held() -> float:
        with open("/proc/self/smaps_rollup") as file:
            return sum(int(line.split()[1]) for line in file if line.startswith("Private_Dirty")) / 1024

    for _ in batches:
        large = np.ones(1 << 21)
        del large  # from here on the system's allocator would keep arrays of that size, if it were left to itself
        before = held()
        arrays = [np.ones(1 << 18) for _ in range(100)]
        arrow = [pa.array(a).cast(pa.int64()) for a in arrays]
        arrays, arrow = arrays[-1:], arrow[-1:]
        gc.collect()
        yield pa.RecordBatch.from_arrays([pa.array([held() - before])], names=["mb"])


def test_workers_give_freed_memory_back(spark):
    reach_package(spark)
    rows = spark.range(1, numPartitions=1).mapInArrow(kept, "mb double").collect()
    assert [r["mb"] < 40 for r in rows] == [True]


def test_settings_of_the_session_stay(spark):
    environment = spark.sparkContext.environment
    reach_package(spark)
    before = environment["MALLOC_ARENA_MAX"]
    environment["MALLOC_ARENA_MAX"] = "7"
    try:
        reach_package(spark)
        assert environment["MALLOC_ARENA_MAX"] == "7"
    finally:
        environment["MALLOC_ARENA_MAX"] = before
